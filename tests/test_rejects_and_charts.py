"""Rejected lines, bounded chart data, and copies that arrive again."""

import random

import pytest
from pyspark.sql import functions as F

from tallymill.fixtures import tx
from tallymill.functions.tokens import TokenKeys, decrypt_columns
from tallymill.operators.batching import slice_rows
from tallymill.operators.cleaning import clean, drop_step
from tallymill.operators.position import BlockIndex
from tallymill.operators.serving import chart_status, scatter_sample
from tallymill.schema import PROTECTED_COLUMNS
from tallymill.sources.files import read_csv_with_rejects, stage_csv_with_rejects, write_csv
from tallymill.streaming.arrivals import count_arrivals, fraud_by_type_counted, land_arrivals, read_arrivals, read_landed

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4096")
    yield
    spark.conf.set(name, before)


def test_rejects_lie_beside_rows_without_gaps(spark, tmp_path, small_splits):
    """Malformed values, too few and too many of them, over several files and splits; rows keep the order of lines."""
    source, draw, good, bad, number = tmp_path / "csv", random.Random(1), [], [], 0
    source.mkdir()
    for name in "abc":
        lines = ["note,id,when"]
        for _ in range(700):
            text = draw.choice(["note {},{},2020-01-02", "note {},x{},2020-01-02", "note {},{}", "note {},{},2020-01-02,more", "{}, {},soon"])
            line = text.format(number, number)
            (good if text == "note {},{},2020-01-02" else bad).append((number, line))
            lines.append(line)
            number += 1
        (source / f"{name}.csv").write_text("\n".join(lines) + "\n")
    schema = spark.createDataFrame([], "id bigint, note string, when date").schema
    staged = stage_csv_with_rejects(read_csv_with_rejects(spark, str(source), schema), str(tmp_path / "staged"))
    assert (staged.row_count, staged.reject_count) == (len(good), len(bad))
    assert sorted(row["line"] for row in staged.rejects.collect()) == sorted(line for _, line in bad)
    assert staged.rows.select("_file", "_block").distinct().count() > 3
    index = BlockIndex.load(spark, str(tmp_path / "staged" / "rejected=false"))
    for start, end in ((0, 1), (3, 400), (100, 5000)):
        rows = slice_rows(staged.rows, start, end, index).collect()
        assert sorted(row["id"] for row in rows) == [n for n, _ in good][start:end]


@pytest.mark.parametrize("lines", [[], ["1,a"], ["x,a"]])
def test_sources_without_rows_or_without_rejects(spark, tmp_path, lines):
    (tmp_path / "only.csv").write_text("\n".join(["id,note", *lines]) + "\n")
    schema = spark.createDataFrame([], "id bigint, note string").schema
    staged = stage_csv_with_rejects(read_csv_with_rejects(spark, str(tmp_path / "only.csv"), schema), str(tmp_path / "staged"))
    assert staged.rows.count() == staged.row_count == sum(line[0] == "1" for line in lines)
    assert staged.rejects.count() == staged.reject_count == sum(line[0] == "x" for line in lines)


def test_rejected_arrivals_are_protected(spark, sf_dir, tmp_path):
    source, landed, checkpoint = (str(tmp_path / name) for name in ("source", "landed", "progress"))
    write_csv(tx(spark, sf_dir).withColumn("amount", F.when(F.col("transactionID") == 5, F.lit("much")).otherwise(F.col("amount").cast("string"))), source)
    keys = TokenKeys.from_text(spark, KEY)
    for _ in range(2):
        land_arrivals(read_arrivals(spark, source, rejects=True), landed, checkpoint, keys).awaitTermination()
    (reject,) = read_landed(spark, landed, keys, rejects=True).collect()
    assert reject["line"].split(",")[1] == "5" and ",much," in reject["line"]
    assert "much" not in spark.read.parquet(f"{landed}/rejected=true").first()["_rejected_line"]
    assert read_landed(spark, landed, keys).count() == tx(spark, sf_dir).count() - 1


def test_a_sample_is_the_same_for_any_partitions_and_small(spark, sf_dir):
    rows = clean(drop_step(tx(spark, sf_dir)))
    rows = rows.union(rows.limit(3).withColumn("amount", F.lit(None).cast("double")))
    for x, y, points in (("transactionID", "isFraud", 200), ("timestamp", "amount", 300), ("transType", "transactionID", 400), ("amount", "amount", 300)):
        sample = scatter_sample(rows, x, y, points)
        found = sorted(map(tuple, sample.collect()), key=str)
        assert sorted(map(tuple, scatter_sample(rows.repartition(13), x, y, points).collect()), key=str) == found
        assert 0 < len(found) <= points
        assert sample.columns == [*dict.fromkeys((x, y)), "cell_rows"]
    one_each = scatter_sample(rows, "transactionID", "isFraud", 3 * 17)
    assert one_each.agg(F.sum("cell_rows")).first()[0] == rows.count()


def test_samples_of_odd_tables(spark, sf_dir):
    rows = clean(drop_step(tx(spark, sf_dir)))
    assert scatter_sample(rows.limit(0)).collect() == []
    one = rows.filter("transactionID = 1")
    assert scatter_sample(one.union(one)).select("cell_rows").collect() == [(2 * one.count(),)] * min(1, one.count())
    nothing = rows.withColumn("amount", F.lit(None).cast("double"))
    assert scatter_sample(nothing, "amount", "amount", 300).select("amount").distinct().collect() == [(None,)]
    with pytest.raises(ValueError):
        scatter_sample(rows, points=3)
    with pytest.raises(ValueError):
        scatter_sample(rows, "isFraud", "timestamp")


def test_chart_status(spark, sf_dir):
    rows = clean(drop_step(tx(spark, sf_dir)))
    charts = {"a": ("transactionID", "isFraud"), "b": ("absent",)}
    assert dict(map(tuple, chart_status(rows, charts).collect())) == {"a": "ready", "b": "missing column"}
    assert dict(map(tuple, chart_status(rows.limit(0), charts).collect())) == {"a": "empty", "b": "missing column"}


def test_copies_count_once_across_steps_and_restarts(spark, sf_dir, tmp_path):
    source, landed, summaries, checkpoint = (str(tmp_path / name) for name in ("source", "landed", "summaries", "progress"))
    keys, rows = TokenKeys.from_text(spark, KEY), tx(spark, sf_dir)
    other_step = rows.filter("transactionID % 5 = 0").withColumn("step", F.col("step") + 1)
    for number, turn in enumerate([rows.filter("transactionID < 200"), rows.union(rows), other_step, None]):
        if turn is not None:
            write_csv(turn, f"{source}/turn={number}")
        count_arrivals(read_arrivals(spark, f"{source}/*"), landed, summaries, checkpoint, keys).awaitTermination()
    found = decrypt_columns(spark.read.parquet(landed), PROTECTED_COLUMNS, keys)
    assert sorted(r[0] for r in found.select("transactionID").collect()) == sorted(r[0] for r in rows.select("transactionID").collect())
    counted = {row["transType"]: row["total_transactions"] for row in fraud_by_type_counted(spark, summaries).collect()}
    expected = clean(drop_step(rows)).groupBy("transType").count().collect()
    assert counted == {row["transType"]: row["count"] for row in expected}
