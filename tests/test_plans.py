"""Landing, transforming, publishing and streaming end to end."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallymill.__main__ import run
from tallymill.fixtures import positioned_tx, tx
from tallymill.functions.tokens import TokenKeys, decrypt_columns
from tallymill.operators import metrics
from tallymill.operators.batching import batch_slice, fan_out
from tallymill.operators.cleaning import clean, drop_step
from tallymill.operators.contract import ContractError, conform
from tallymill.operators.position import with_source_position
from tallymill.plans.ingest import ingest_all, ingest_batch, protect
from tallymill.plans.publish import SERVED_TABLES, Snapshot, expire, publish_jdbc, read_published
from tallymill.plans.run import run_all, run_batch
from tallymill.plans.transform import transform_batch
from tallymill.schema import BATCH_COUNT, FLAG_COLUMNS, FRAUD_BY_TYPE, FRAUD_STATS, TRANSFORMED_DATA
from tallymill.scratch import scratch_path
from tallymill.sources import files
from tallymill.sources.jdbc import postgres_url, read_jdbc, write_jdbc
from tallymill.streaming.arrivals import fraud_by_type_so_far, land_arrivals, publish_arrivals, read_arrivals

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
NAMES = ["nameOrig", "nameDest"]


@pytest.fixture(scope="module")
def keys(spark):
    return TokenKeys.from_text(spark, KEY)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return positioned_tx(spark, sf_dir)


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def by_type(df):
    return {row["transType"]: row["total_transactions"] for row in df.collect()}


def test_landed_batch_is_protected_and_replaced(spark, rows, keys, tmp_path):
    landed = str(tmp_path / "landed")
    ingest_batch(rows, landed, 100, 2, keys)
    ingest_batch(rows, landed, 100, 3, keys)
    first = files.read_batch(spark, landed, 2).select("nameOrig").collect()
    assert all(row["nameOrig"].startswith("gAAAA") for row in first)
    ingest_batch(rows, landed, 100, 2, keys)
    stored = files.read_batch(spark, landed, 2)
    assert same(decrypt_columns(stored, NAMES, keys), drop_step(batch_slice(rows, 100, 2)))
    assert files.read_batch(spark, landed, 3).count() == 200
    assert not os.path.exists(f"{landed}/batch=2/_SUCCESS")


def test_an_empty_batch_replaces_an_older_one(spark, rows, keys, tmp_path):
    landed = str(tmp_path / "landed")
    ingest_batch(rows, landed, 100, 11, keys, span=1)
    assert files.read_batch(spark, landed, 11).isEmpty()
    ingest_batch(rows, landed, 10, 11, keys)
    assert files.read_batch(spark, landed, 11).count() == 20
    ingest_batch(rows, landed, 100, 11, keys)
    assert files.read_batch(spark, landed, 11).isEmpty()


def test_reading_a_batch_touches_no_other(spark, rows, tmp_path):
    landed = str(tmp_path / "landed")
    files.replace_partitions(fan_out(rows, 100), landed, "batch")
    assert {path.split("/")[-2] for path in files.read_batch(spark, landed, 3).inputFiles()} == {"batch=3"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_batch(spark, landed, 13)


def test_published_batches_are_pruned(spark, rows, keys, tmp_path):
    run_all(rows, str(tmp_path / "landed"), str(tmp_path / "served"), 100, keys, BATCH_COUNT)
    last = read_published(spark, str(tmp_path / "served"), TRANSFORMED_DATA)
    plan = last._sc._jvm.PythonSQLUtils.explainString(last._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(batch" in plan and "= 12)]" in plan


def test_replacing_one_partition_leaves_the_others(spark, rows, tmp_path):
    path = str(tmp_path / "batches")
    files.replace_partitions(fan_out(rows, 100), path, "batch")
    files.replace_partitions(spark.read.parquet(path).filter("batch = 3").limit(5).withColumn("batch", F.lit(4)), path, "batch")
    assert {row["batch"]: row["count"] for row in spark.read.parquet(path).groupBy("batch").count().collect()} == {
        **{number: 200 for number in range(1, 10)}, 10: 100, 4: 5
    }


def test_one_pass_gives_what_single_runs_give(spark, rows, keys, tmp_path):
    """With copies of rows within a batch and across its segments."""
    source = str(tmp_path / "source")
    table = rows.drop("_file", "_block", "_row")
    table.union(table.filter("transactionID between 90 and 310")).union(table.filter("transactionID < 5")).coalesce(1).write.parquet(source)
    copied = with_source_position(spark.read.parquet(source))
    batches = 5
    run_all(copied, str(tmp_path / "landed-all"), str(tmp_path / "served-all"), 400, keys, batches)
    for batch in range(1, batches + 1):
        run_batch(copied, str(tmp_path / "landed"), str(tmp_path / "served"), 400, batch, keys)
    for name in SERVED_TABLES:
        at_once = read_published(spark, str(tmp_path / "served-all"), name, history=True)
        one_by_one = read_published(spark, str(tmp_path / "served"), name, history=True)
        columns = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in at_once.dtypes]
        assert same(at_once.select(columns), one_by_one.select(columns)), name
        latest = read_published(spark, str(tmp_path / "served-all"), name)
        assert same(latest, one_by_one.filter(F.col("batch") == batches).drop("batch")), name
    stats = read_published(spark, str(tmp_path / "served-all"), FRAUD_STATS, history=True)
    assert stats.count() == batches
    landed = spark.read.parquet(str(tmp_path / "landed-all"))
    assert landed.count() == copied.count()


def test_latest_and_history(spark, rows, keys, tmp_path):
    landed, served = str(tmp_path / "landed"), str(tmp_path / "served")
    run_batch(rows, landed, served, 100, 1, keys)
    run_batch(rows, landed, served, 100, 10, keys)
    expected = {
        batch: by_type(metrics.fraud_by_type(metrics.summarize(clean(drop_step(batch_slice(rows, 100, batch))))))
        for batch in (1, 10)
    }
    assert by_type(read_published(spark, served, FRAUD_BY_TYPE)) == expected[10]
    history = read_published(spark, served, FRAUD_BY_TYPE, history=True)
    assert {batch: by_type(history.filter(F.col("batch") == batch)) for batch in (1, 10)} == expected
    run_batch(rows, landed, served, 50, 1, keys)
    assert sum(by_type(read_published(spark, served, FRAUD_BY_TYPE)).values()) < sum(expected[1].values())
    assert history.columns[-1] == "batch" and read_published(spark, served, FRAUD_BY_TYPE, True).count() == 10


def by_hand(spark, served, batch, total, started=None):
    """A snapshot of one metric table with one row."""
    snapshot = started or Snapshot(spark, served)
    snapshot.write(FRAUD_BY_TYPE, spark.createDataFrame([("PAYMENT", total)], "transType string, total_transactions long"), batch)
    return snapshot


def test_the_order_is_that_of_announcement(spark, tmp_path):
    served = str(tmp_path / "served")
    early = Snapshot(spark, served)
    by_hand(spark, served, 1, 2).announce([1])
    by_hand(spark, served, 1, 3, early).announce([1])
    assert by_type(read_published(spark, served, FRAUD_BY_TYPE)) == {"PAYMENT": 3}
    assert by_type(read_published(spark, served, FRAUD_BY_TYPE, history=True)) == {"PAYMENT": 3}


def test_history_takes_few_jobs_and_old_snapshots_expire(spark, tmp_path):
    served = str(tmp_path / "served")
    for batch in (*range(1, 41), 7):
        by_hand(spark, served, batch, batch * (2 if batch == 7 else 1)).announce([batch])
    half = by_hand(spark, served, 3, 99)
    for name in SERVED_TABLES:
        os.makedirs(f"{served}/{name}", exist_ok=True)
    spark.sparkContext.setJobGroup("history", "history")
    found = {row["batch"]: row["total_transactions"] for row in read_published(spark, served, FRAUD_BY_TYPE, True).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("history")
    spark.sparkContext.setJobGroup("others", "others")
    assert sorted(found) == list(range(1, 41)) and found[3] == 3 and found[7] == 14
    assert len(jobs) <= 12
    assert expire(spark, served, 3600) == []
    gone = expire(spark, served, 0)
    assert len(gone) == 2 and half.name in gone
    again = {row["batch"]: row["total_transactions"] for row in read_published(spark, served, FRAUD_BY_TYPE, True).collect()}
    assert again == found


def test_a_failed_run_changes_nothing_for_readers(spark, rows, keys, tmp_path):
    landed, served = str(tmp_path / "landed"), str(tmp_path / "served")
    run_batch(rows, landed, served, 100, 1, keys)
    before = {name: read_published(spark, served, name).count() for name in SERVED_TABLES}
    files.write_batch(protect(batch_slice(rows, 100, 2), keys).drop("amount"), landed, 2)
    with pytest.raises(ContractError):
        transform_batch(spark, landed, 2, keys, served)
    files.write_batch(protect(batch_slice(rows, 100, 2).withColumn("nameDest", F.lit(None).cast("string")), keys), landed, 3)
    with pytest.raises(ContractError, match="not_null of nameDest"):
        transform_batch(spark, landed, 3, keys, served, strict=True)
    half = Snapshot(spark, served)
    half.write(FRAUD_BY_TYPE, read_published(spark, served, FRAUD_BY_TYPE), 4)
    assert {name: read_published(spark, served, name).count() for name in SERVED_TABLES} == before


def test_a_wrong_key_stops_the_run(spark, rows, keys, tmp_path):
    landed = str(tmp_path / "landed")
    ingest_batch(rows, landed, 100, 1, keys)
    other = TokenKeys.from_text(spark, "A" * 43 + "=")
    with pytest.raises(Exception, match="not valid"):
        transform_batch(spark, landed, 1, other, str(tmp_path / "served"))
    assert not os.path.exists(tmp_path / "served" / "published")


def test_plans_shuffle_once(spark, rows, keys, tmp_path):
    """Cleaning a batch: one exchange of its rows and no Python."""
    landed = str(tmp_path / "landed")
    ingest_all(rows, landed, 100, keys)
    cleaned = clean(spark.read.parquet(landed), keys)
    plan = cleaned._sc._jvm.PythonSQLUtils.explainString(cleaned._jdf.queryExecution(), "formatted")
    assert plan.count("\n+- Exchange") + plan.count("- Exchange (") == 1
    assert "Python" not in plan and "SinglePartition" not in plan


def test_csv_keeps_microseconds_and_types(spark, sf_dir, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(tx(spark, sf_dir), path)
    back = files.read_csv(spark, path).withColumns({name: F.col(name).cast("int") for name in FLAG_COLUMNS})
    assert back.schema == tx(spark, sf_dir).schema or back.dtypes == tx(spark, sf_dir).dtypes
    assert same(back, tx(spark, sf_dir))
    assert dict(files.read_csv(spark, path, schema=None).dtypes)["transactionID"] == "int"


# JDBC against a database inside this process


@pytest.fixture
def database(request):
    return f"jdbc:derby:memory:{request.node.name.split('[')[0]};create=true"


def test_jdbc_replaces_or_truncates(spark, database):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    write_jdbc(first, database, "things", column_types="name VARCHAR(10)")
    write_jdbc(first.filter("id = 2"), database, "things", truncate=True)
    assert [tuple(row) for row in read_jdbc(spark, database, "things").collect()] == [(2, "b")]
    write_jdbc(first.select("id"), database, "things")
    assert read_jdbc(spark, database, "things").columns == ["id"]


def test_jdbc_empty_table(spark, database):
    write_jdbc(spark.createDataFrame([], "id bigint"), database, "nothing")
    assert read_jdbc(spark, database, "nothing").count() == 0


def test_jdbc_errors_reach_the_caller(spark):
    with pytest.raises(Exception):
        write_jdbc(spark.range(1), "jdbc:derby:memory:absent", "things")


def test_jdbc_parallel_read_and_query(spark, database):
    write_jdbc(spark.range(1000), database, "numbers")
    parts = read_jdbc(spark, database, "numbers", split_by=("id", 0, 1000, 4))
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 1000
    query = '(SELECT 1 AS "test_column" FROM sysibm.sysdummy1) AS test_query'
    assert [tuple(row) for row in read_jdbc(spark, database, query).collect()] == [(1,)]


def test_served_tables_reach_the_database(spark, rows, keys, database, tmp_path):
    run_batch(rows, str(tmp_path / "landed"), str(tmp_path / "served"), 100, 2, keys)
    tables = {name: read_published(spark, str(tmp_path / "served"), name) for name in SERVED_TABLES}
    publish_jdbc(tables, database, {})
    for name, table in tables.items():
        assert same(read_jdbc(spark, database, name), table), name
    publish_jdbc(tables, database, {}, declared_types=True)
    stored = read_jdbc(spark, database, TRANSFORMED_DATA)
    assert dict(stored.dtypes)["amount"] == "decimal(15,2)"
    assert same(stored, conform(tables[TRANSFORMED_DATA]))


def test_postgres_url():
    assert postgres_url("db", 5432, "d", "require") == "jdbc:postgresql://db:5432/d?ssl=true&sslmode=require"


# Streaming


def test_arrivals_land_once(spark, sf_dir, keys, tmp_path):
    source, landed, checkpoint = (str(tmp_path / name) for name in ("source", "landed", "checkpoint"))
    early, late = tx(spark, sf_dir).filter("transactionID < 400"), tx(spark, sf_dir).filter("transactionID >= 400")

    def land(files_per_trigger=None):
        arriving = read_arrivals(spark, f"{source}/*", files_per_trigger=files_per_trigger)
        land_arrivals(arriving, landed, checkpoint, keys).awaitTermination()
        return spark.read.parquet(landed)

    files.write_csv(early, f"{source}/month=1")
    assert land(files_per_trigger=1).count() == 400
    assert land().count() == 400
    files.write_csv(late, f"{source}/month=2")
    stored = land().withColumns({name: F.col(name).cast("int") for name in FLAG_COLUMNS})
    assert same(decrypt_columns(stored, NAMES, keys), drop_step(tx(spark, sf_dir)))
    assert stored.select("nameOrig").distinct().count() == stored.count()
    whole = metrics.fraud_by_type(metrics.summarize(clean(drop_step(tx(spark, sf_dir)))))
    assert by_type(fraud_by_type_so_far(spark, landed, keys)) == by_type(whole)


def test_a_step_run_again_replaces_its_batch(spark, sf_dir, keys, tmp_path):
    """As after a failure between publishing and the checkpoint: the checkpoint is lost, the files are the same."""
    source, landed, served = (str(tmp_path / name) for name in ("source", "landed", "served"))
    files.write_csv(tx(spark, sf_dir), source)
    for checkpoint in ("first", "second"):
        arriving = read_arrivals(spark, source)
        publish_arrivals(arriving, landed, served, str(tmp_path / checkpoint), keys).awaitTermination()
    expected = clean(drop_step(tx(spark, sf_dir)))
    assert same(read_published(spark, served, TRANSFORMED_DATA, history=True).drop("batch"), expected)
    assert os.listdir(landed) == ["batch=1"]


def test_all_new_files_make_one_batch(spark, sf_dir, keys, tmp_path):
    source, landed, served = (str(tmp_path / name) for name in ("source", "landed", "served"))
    files.write_csv(tx(spark, sf_dir).repartition(5), source)
    publish_arrivals(read_arrivals(spark, source), landed, served, str(tmp_path / "checkpoint"), keys).awaitTermination()
    assert os.listdir(landed) == ["batch=1"]


@pytest.mark.parametrize("column, value", [("amount", "abc"), ("timestamp", "01/02/2024 10:00"), ("step", "1.5")])
def test_malformed_values_are_errors(spark, sf_dir, tmp_path, column, value):
    path = str(tmp_path / "csv")
    files.write_csv(tx(spark, sf_dir).limit(5).withColumn(column, F.lit(value)), path)
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path).collect()
    assert files.read_csv(spark, path, mode="PERMISSIVE").filter(F.col(column).isNull()).count() == 5


def test_strict_rules_hold_for_all_batches(spark, sf_dir, keys, tmp_path):
    raw, landed, served = positioned_tx(spark, sf_dir), str(tmp_path / "landed"), str(tmp_path / "served")
    run_all(raw, landed, served, 200, keys, strict=True)
    broken = raw.withColumn("amount", F.lit(1e14))
    with pytest.raises(ContractError, match="amount"):
        run_all(broken, str(tmp_path / "broken"), served, 200, keys, strict=True)


def test_a_file_with_other_columns_is_an_error(spark, keys, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "odd.csv").write_text("transactionID,step\n1,2\n")
    arriving = read_arrivals(spark, str(source))
    with pytest.raises(Exception):
        land_arrivals(arriving, str(tmp_path / "landed"), str(tmp_path / "checkpoint"), keys).awaitTermination()


# Command line and scratch space


def test_command_line(spark, sf_dir, rows, tmp_path, monkeypatch, capsys, database):
    monkeypatch.setenv("ENCRYPTION_KEY", KEY)
    monkeypatch.setenv("BATCH_SIZE", "100")
    raw, staged, landed, served = (str(tmp_path / name) for name in ("raw", "staged", "landed", "served"))
    files.write_csv(tx(spark, sf_dir), raw)
    run(spark, ["stage", raw, staged])
    run(spark, ["ingest", "2", "--source", staged, "--landed", landed, "--preview"])
    assert "nameOrig: string" in capsys.readouterr().out
    run(spark, ["transform", "2", "--landed", landed, "--served", served, "--strict", "--jdbc-url", database])
    expected = clean(drop_step(batch_slice(rows, 100, 2)))
    assert same(read_published(spark, served, TRANSFORMED_DATA), expected)
    assert same(read_jdbc(spark, database, TRANSFORMED_DATA), expected)
    run(spark, ["ingest-all", "--source", staged, "--landed", f"{landed}-all", "--batches", "3"])
    assert "600 rows lie behind batch 3" in capsys.readouterr().out
    run(spark, ["ingest-all", "--source", staged, "--landed", f"{landed}-all", "--partitions", "2"])
    run(spark, ["transform-all", "--landed", f"{landed}-all", "--served", f"{served}-all", "--preview"])
    assert read_published(spark, f"{served}-all", FRAUD_STATS, history=True).count() == 10
    run(spark, ["arrivals", raw, f"{landed}-new", str(tmp_path / "checkpoint")])
    assert spark.read.parquet(f"{landed}-new").count() == 1000
    arrived = ["arrivals", raw, f"{landed}-b", str(tmp_path / "progress"), "--served", f"{served}-b"]
    run(spark, [*arrived, "--jdbc-url", database, "--connections", "3"])
    assert read_jdbc(spark, database, TRANSFORMED_DATA).count() == clean(drop_step(tx(spark, sf_dir))).count()
    run(spark, ["expire", f"{served}-b", "--unchanged-for", "0"])
    assert read_published(spark, f"{served}-b", FRAUD_STATS).count() == 1
    monkeypatch.delenv("BATCH_SIZE")
    with pytest.raises(ValueError):
        run(spark, ["ingest", "2", "--source", staged, "--landed", landed])


class Session:
    """A session as far as scratch paths look at it."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default)


def test_scratch_follows_the_setting(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(Session("yarn", "hdfs://shared/"), "x").startswith("hdfs://shared/tallymill/x-")
    assert os.path.isabs(scratch_path(Session("local[4]"), "x"))
    with pytest.raises(RuntimeError):
        scratch_path(Session("yarn"), "x")


@pytest.mark.parametrize("name", ["served_latest", "served_history"])
def test_batches_that_are_published_in_turn_share_an_index_and_all_tasks(spark, sf_dir, monkeypatch, name):
    import __spark_entry__ as entry

    calls = []

    def recorded(*args, **kwargs):
        calls.append(kwargs)
        return run_batch(*args, **kwargs)

    monkeypatch.setattr(entry, "run_batch", recorded)
    assert entry.queries()[name](spark, sf_dir).count()
    assert [call["partitions"] for call in calls] == [spark.sparkContext.defaultParallelism] * 3
    assert len({id(call["index"]) for call in calls}) == 1
