"""The index of blocks, batch numbers by arithmetic, and how many files a partitioned write leaves."""

import glob
import itertools

import pytest
from pyspark.sql import functions as F

from tallymill.fixtures import positioned_tx
from tallymill.functions.tokens import TokenKeys
from tallymill.operators import position
from tallymill.operators.batching import batch_slice, fan_out, with_segment
from tallymill.operators.position import BlockIndex, StaleIndexError, stage_in_key_order
from tallymill.plans.publish import read_published
from tallymill.plans.run import run_all
from tallymill.sources.files import write_table
from tallymill.sources.layout import Layout

_groups = itertools.count()


def jobs(spark, run):
    """How many jobs ``run`` starts."""
    group = f"counted-{next(_groups)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def explained(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def data_files(path):
    return [name for name in glob.glob(f"{path}/**/*.parquet", recursive=True) if "/_" not in name.removeprefix(path)]


@pytest.fixture
def staged(spark, sf_dir, tmp_path):
    path = str(tmp_path / "staged")
    stage_in_key_order(positioned_tx(spark, sf_dir), ["amount"], path, partitions=5)
    return path


def test_a_stored_index_spares_the_table(spark, staged):
    rows, index = spark.read.parquet(staged), BlockIndex.load(spark, staged)
    assert index.rows == rows.count()
    plans = []
    assert jobs(spark, lambda: plans.append(batch_slice(rows, 100, 2, index=index))) == 1
    assert f"{staged}/_blocks" in explained(index.blocks) and "Scan parquet" in explained(index.blocks)
    assert sorted(map(tuple, plans[0].collect())) == sorted(map(tuple, batch_slice(rows, 100, 2).collect()))
    assert "Exchange" not in explained(plans[0])


def test_an_index_of_other_files_is_refused(spark, staged):
    spark.read.parquet(staged).limit(3).write.mode("append").parquet(staged)
    with pytest.raises(StaleIndexError):
        BlockIndex.load(spark, staged)


@pytest.mark.parametrize("broadcast, colliding", [(True, False), (False, False), (True, True)])
def test_ranks_by_every_join(spark, staged, monkeypatch, broadcast, colliding):
    rows = spark.read.parquet(staged)
    monkeypatch.setattr(position, "BROADCAST_BLOCKS", 10**6 if broadcast else 1)
    index = BlockIndex.of(rows)
    if colliding:
        index = BlockIndex(index.blocks.withColumn("_key", F.lit(1).cast("bigint")))
    ranked = index.with_rank(rows).orderBy("_block", "_row").select("_rank").collect()
    assert [row["_rank"] for row in ranked] == list(range(rows.count()))


def test_the_plan_is_the_same_for_any_number_of_batches(spark, sf_dir):
    rows = positioned_tx(spark, sf_dir)
    index = BlockIndex.of(rows)
    few, many = (len(explained(fan_out(rows, size, index=index)).splitlines()) for size in (500, 1))
    assert few == many
    assert with_segment(rows, 1, 10**6, index).select("segment").distinct().count() == index.rows


def test_many_batches_leave_few_files(spark, sf_dir, tmp_path):
    """A hundred batches by 64 tasks; ingestion deals rows out to 16 tasks."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    rows = positioned_tx(spark, sf_dir)
    landed, served = str(tmp_path / "landed"), str(tmp_path / "served")
    size = -(-rows.count() // 100)
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        run_all(rows, landed, served, size, TokenKeys.from_text(spark, "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="), partitions=16)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert len(data_files(landed)) <= 100 + 16
    assert len(data_files(f"{served}/transformed_data")) <= 100
    expected = fan_out(rows.filter("isFraud IS NOT NULL"), size, batches=100)
    served_rows = read_published(spark, served, "transformed_data", history=True)
    whole = fan_out(rows, size).filter("isFraud IS NOT NULL")
    assert sorted(map(tuple, served_rows.select("batch", "transactionID").collect())) == sorted(
        map(tuple, whole.select("batch", "transactionID").collect())
    )
    assert expected.columns == whole.columns


def test_a_hot_batch_is_split_and_small_ones_share_tasks(spark, tmp_path):
    rows = spark.range(9000).withColumn("batch", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("int"))
    counts = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
    layout = Layout(counts, rows_per_file=500)
    hot = counts.filter("batch = 0").first()["rows"]
    assert layout.files == 39 + -(-hot // 500)
    placed = layout.apply(rows)
    sizes = [row["count"] for row in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < hot / 2
    path = str(tmp_path / "table")
    write_table(placed, path, "batch")
    assert len(data_files(path)) <= layout.files
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, rows.collect()))


def test_rows_of_unknown_or_no_batch_are_kept(spark):
    rows = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, batch int")
    layout = Layout(spark.createDataFrame([(1, 1)], "batch int, rows bigint"))
    assert sorted(map(tuple, layout.apply(rows).select("id").collect())) == [(1,), (2,), (3,)]
    empty = Layout(spark.createDataFrame([], "batch int, rows bigint"))
    assert empty.apply(rows).count() == 3 and not empty.wanted(8)
