"""Loads into a database beside the old table, balanced reads, checks during the write, and announcements."""

import itertools
import threading

import pytest
from pyspark.sql import functions as F

from tallymill.fixtures import positioned_tx, tx
from tallymill.functions.tokens import TokenKeys
from tallymill.operators import contract
from tallymill.operators.cleaning import clean, drop_step
from tallymill.plans.ingest import ingest_batch
from tallymill.plans.publish import SERVED_TABLES, Snapshot, publish_jdbc, read_published
from tallymill.plans.run import run_batch
from tallymill.plans.transform import transform_batch
from tallymill.schema import TRANSFORMED_DATA
from tallymill.scratch import create_once
from tallymill.sources import jdbc
from tallymill.sources.files import write_table
from tallymill.sources.jdbc import Load, LoadError, balanced_ranges, publish, read_balanced, read_jdbc, write_jdbc

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="


@pytest.fixture
def database(request):
    name = "".join(c for c in request.node.name if c.isalnum())
    return f"jdbc:derby:memory:{name};create=true"


def tables(spark, database):
    query = "(SELECT tablename AS \"name\" FROM sys.systables WHERE tabletype = 'T') known"
    return {row["name"] for row in read_jdbc(spark, database, query).collect()}


def failing(df):
    """The frame, but one of its later rows cannot be worked out."""
    return df.withColumn("id", F.when(F.col("id") == 900, F.raise_error(F.lit("broken row")).cast("bigint")).otherwise(F.col("id")))


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


def test_a_failing_load_leaves_the_old_table(spark, database):
    write_jdbc(spark.range(5), database, "things")
    for truncate in (False, True):
        with pytest.raises(Exception, match="broken row"):
            write_jdbc(failing(spark.range(1000)), database, "things", truncate=truncate)
        assert ids(read_jdbc(spark, database, "things")) == list(range(5))
    assert tables(spark, database) == {"THINGS"}


def test_a_failing_swap_leaves_the_old_tables(spark, database):
    for name in ("first", "second"):
        write_jdbc(spark.range(3), database, f"{name}_table")
    loads = [Load(spark.range(9), database, f"{name}_table") for name in ("first", "second")]
    loads[1].abandon()
    with pytest.raises(Exception):
        publish(loads)
    for name in ("first", "second"):
        assert ids(read_jdbc(spark, database, f"{name}_table")) == [0, 1, 2]
    assert tables(spark, database) == {"FIRST_TABLE", "SECOND_TABLE"}


def test_parts_that_came_twice_are_sent_again(spark, database, monkeypatch):
    """As when a task is run again after its commit."""
    append, sent = Load._append, []

    def twice(self, rows, *rest):
        append(self, rows, *rest)
        if not sent:
            append(self, rows.filter("_part = 1"), *rest)
        sent.append(rows)

    monkeypatch.setattr(Load, "_append", twice)
    write_jdbc(spark.range(0, 1000, 1, 4), database, "things")
    assert ids(read_jdbc(spark, database, "things")) == list(range(1000))
    assert len(sent) == 2
    monkeypatch.setattr(Load, "_append", lambda self, rows, *rest: [append(self, rows, *rest) for _ in range(2)])
    with pytest.raises(LoadError):
        write_jdbc(spark.range(10), database, "things")
    assert ids(read_jdbc(spark, database, "things")) == list(range(1000))


def test_truncate_keeps_the_declared_types(spark, database):
    things = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    write_jdbc(things, database, "things", column_types="name VARCHAR(7)")
    query = (
        "(SELECT CAST(columndatatype AS VARCHAR(99)) AS \"kind\" FROM sys.syscolumns c JOIN sys.systables t"
        " ON c.referenceid = t.tableid WHERE t.tablename = 'THINGS' AND columnname = 'name') known"
    )
    for truncate, kind in ((True, "VARCHAR(7)"), (False, "CLOB")):
        write_jdbc(things, database, "things", truncate=truncate)
        assert kind in read_jdbc(spark, database, query).first()["kind"]
        assert ids(read_jdbc(spark, database, "things")) == [1, 2]


def test_all_served_tables_or_none(spark, sf_dir, database, tmp_path):
    served = str(tmp_path / "served")
    keys = TokenKeys.from_text(spark, KEY)
    found = []
    for batch in (1, 2):
        run_batch(positioned_tx(spark, sf_dir), str(tmp_path / "landed"), served, 100, batch, keys)
        found.append({name: read_published(spark, served, name) for name in SERVED_TABLES})
    publish_jdbc(found[0], database, {})
    last = SERVED_TABLES[-1]
    broken = found[1][last].withColumn("total_flagged", F.raise_error(F.lit("broken row")).cast("bigint"))
    with pytest.raises(Exception, match="broken row"):
        publish_jdbc(found[1] | {last: broken}, database, {})
    for name in SERVED_TABLES:
        assert read_jdbc(spark, database, name).count() == found[0][name].count()
    kept = read_jdbc(spark, database, TRANSFORMED_DATA).agg(F.sum("transactionID")).first()
    assert kept == found[0][TRANSFORMED_DATA].agg(F.sum("transactionID")).first()
    assert len(tables(spark, database)) == len(SERVED_TABLES)


@pytest.mark.parametrize("shift", [0, -(10**12)])
def test_balanced_ranges_of_a_skewed_key(spark, database, shift):
    """Nine tenths of the keys lie in a millionth of the range."""
    rows = spark.range(2000).selectExpr(f"CASE WHEN id % 10 = 0 THEN id * 1000000000 ELSE id END + ({shift}) AS id", "id AS place")
    write_jdbc(rows.union(spark.sql("SELECT NULL, -1")), database, "things")
    ranges = balanced_ranges(spark, database, "things", "id", 8)
    assert len(ranges) == 8 and all(a[1] == b[0] for a, b in itertools.pairwise(ranges))
    found = read_balanced(spark, database, "things", "id", 8)
    assert sorted(row["place"] for row in found.collect()) == list(range(-1, 2000))
    sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 2001 / 8


def test_balanced_reads_of_one_key_and_of_nothing(spark, database):
    write_jdbc(spark.range(50).selectExpr("7L AS id"), database, "same")
    assert ids(read_balanced(spark, database, "same", "id", 4)) == [7] * 50
    write_jdbc(spark.createDataFrame([], "id bigint"), database, "nothing")
    assert read_balanced(spark, database, "nothing", "id", 4).count() == 0


def test_rules_are_counted_during_the_write(spark, sf_dir, tmp_path):
    from test_layout import jobs

    rows = clean(drop_step(tx(spark, sf_dir))).withColumn("amount", F.when(F.col("transactionID") % 7 > 0, F.col("amount")))
    watch = contract.Watch(rows)
    plain = jobs(spark, lambda: write_table(rows, str(tmp_path / "plain")))
    assert jobs(spark, lambda: write_table(watch.rows, str(tmp_path / "watched"))) == plain
    expected = {(row["rule"], row["column"]): row["violations"] for row in contract.violations(rows).collect()}
    assert jobs(spark, lambda: watch.violations()) == 0
    assert watch.violations() == expected and expected["not_null", "amount"] > 0
    assert watch.row_count() == rows.count()
    with pytest.raises(contract.ContractError, match="not_null of amount"):
        watch.enforce()


def test_strict_batches_start_two_jobs_less(spark, sf_dir, tmp_path):
    """The rules cost no read of their own; unique keys still do."""
    from test_layout import jobs

    keys, landed = TokenKeys.from_text(spark, KEY), str(tmp_path / "landed")
    ingest_batch(positioned_tx(spark, sf_dir), landed, 100, 2, keys)
    counts = [
        jobs(spark, lambda strict=strict: transform_batch(spark, landed, 2, keys, str(tmp_path / f"served{strict}"), strict))
        for strict in (False, True)
    ]
    alone = jobs(spark, lambda: contract.require_unique_keys(read_published(spark, str(tmp_path / "servedTrue"), TRANSFORMED_DATA)))
    assert counts[1] - counts[0] <= alone


def test_a_file_is_created_once(spark, tmp_path):
    path, granted = f"file:{tmp_path}/claims/1", []
    threads = [threading.Thread(target=lambda: granted.append(create_once(spark, path))) for _ in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(granted) == [False] * 7 + [True]


def test_announcers_at_once_never_share_a_version(spark, tmp_path):
    root, errors = str(tmp_path / "served"), []

    def announce(batch):
        try:
            Snapshot(spark, root).announce([batch])
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=announce, args=(batch,)) for batch in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    log = spark.read.parquet(f"{root}/published").collect()
    assert sorted(row["batch"] for row in log) == list(range(6))
    assert len({row["version"] for row in log}) == 6


def test_cells_are_counted_by_one_query_a_level(spark, database, monkeypatch):
    write_jdbc(spark.range(1000), database, "even")
    levels = []
    count = jdbc._count_cells
    monkeypatch.setattr(jdbc, "_count_cells", lambda *given: levels.append(given) or count(*given))
    ranges = balanced_ranges(spark, database, "even", "id", 4)
    assert len(levels) == 1 and len(ranges) == 4
