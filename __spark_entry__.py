"""

Each query runs over the whole ``tx`` table, which reads as raw transactions what the ``events`` table holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.fixtures import positioned_tx, tx
from tallymill.functions.tokens import TokenKeys, decrypt_columns, encrypt_columns, with_token_check
from tallymill.operators import batching, cleaning, contract, metrics, serving
from tallymill.operators.position import BlockIndex, drop_position, stage_in_key_order
from tallymill.plans.ingest import ingest_all, ingest_batch, protect
from tallymill.plans.publish import SERVED_TABLES, publish_jdbc, read_published
from tallymill.plans.run import run_all, run_batch
from tallymill.schema import (
    BATCH_COUNT,
    FLAG_COLUMNS,
    FLAGGED_FRAUD_ACCURACY,
    FRAUD_BY_TYPE,
    FRAUD_STATS,
    PROTECTED_COLUMNS,
    RAW_SCHEMA,
    TRANSFORMED_DATA,
)
from tallymill.scratch import scratch_path
from tallymill.sources import files
from tallymill.sources.jdbc import read_balanced, read_jdbc, split_by_key, write_jdbc
from tallymill.sources.layout import Layout
from tallymill.streaming.arrivals import (
    count_arrivals,
    fraud_by_type_counted,
    fraud_by_type_of_batches,
    fraud_by_type_so_far,
    land_arrivals,
    publish_arrivals,
    read_arrivals,
    read_landed,
)

try:  # the operators on training text and their pipeline may be absent
    import corpus_pipeline
    from tallymill.llm import queries as training_text
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tallymill.llm"):
        raise
    corpus_pipeline = training_text = None

_SMOKE_DIR = "/root/testdata/sf0.001"

# The key of the public Fernet test vector.
_KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="

# A database inside the driver's own process; name another one to run the JDBC query on a cluster.
_JDBC_URL_SETTING = "spark.tallymill.jdbc.url"
_JDBC_URL = "jdbc:derby:memory:tallymill;create=true"


def _keys(spark: SparkSession) -> TokenKeys:
    return TokenKeys.from_text(spark, _KEY)


def _tasks(spark: SparkSession) -> int:
    """Tasks that protect names: the test table is one file, which alone would be one task."""
    return spark.sparkContext.defaultParallelism


def _batch_size(spark: SparkSession, sf_dir: str) -> int:
    """A tenth of the table: batch 10 is cut short by its end, batches 11 and 12 are empty."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").count() // 10


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(cleaning.drop_step(tx(spark, sf_dir)))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summarize(_cleaned(spark, sf_dir))


def _batch(number: int, span: int = 2) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return batching.batch_slice(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), number, span)

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Fraud by transaction type over the first batch."""
    first = _batch(1)(spark, _SMOKE_DIR)
    return metrics.fraud_by_type(metrics.summarize(cleaning.clean(cleaning.drop_step(first))))


def row_count(spark, sf_dir):
    return tx(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_rows"))


def _number_flags(df: DataFrame) -> DataFrame:
    """Flags that a text file held, as the numbers that it was written from."""
    return df.withColumns({name: F.col(name).cast("int") for name in FLAG_COLUMNS})


def csv_ingest(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(tx(spark, sf_dir), path)
    return _number_flags(files.read_csv(spark, path))


def csv_text_flags(spark, sf_dir):
    """Flags as numbers, truth values, decimals and other text by turns; a row whose label is other text still counts."""
    path = scratch_path(spark, "csv")
    turn = F.col("transactionID") % 4

    def spelled(name):
        flag = F.col(name)
        other = F.when(flag.isNotNull(), F.lit("x"))
        by_turn = F.when(turn == 0, flag.cast("string")).when(turn == 1, flag.cast("boolean").cast("string"))
        return by_turn.when(turn == 2, flag.cast("double").cast("string")).otherwise(other)

    files.write_csv(tx(spark, sf_dir).withColumns({name: spelled(name) for name in FLAG_COLUMNS}), path)
    return cleaning.clean(cleaning.drop_step(files.read_csv(spark, path)))


def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(tx(spark, sf_dir), path)
    inferred = files.read_csv(spark, path, schema=None)
    return inferred.select(*[F.col(field.name).cast(field.dataType) for field in RAW_SCHEMA])


def csv_inferred_types(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(tx(spark, sf_dir), path)
    found = files.read_csv(spark, path, schema=None).dtypes
    return spark.createDataFrame(found, "column string, type string").coalesce(1)


def csv_batch_slice(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(tx(spark, sf_dir), path)
    staged = files.stage_csv(files.read_csv(spark, path), scratch_path(spark, "staged"))
    return _number_flags(batching.batch_slice(staged, _batch_size(spark, sf_dir), 2))


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    files.write_table(tx(spark, sf_dir), path)
    return files.read_table(spark, path)


def batch_read(spark, sf_dir):
    path = scratch_path(spark, "batches")
    batches = batching.fan_out(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), BATCH_COUNT)
    files.replace_partitions(batches, path, "batch")
    return files.read_batch(spark, path, 2)


def jdbc_roundtrip(spark, sf_dir):
    url = spark.conf.get(_JDBC_URL_SETTING, _JDBC_URL)
    path = scratch_path(spark, "outgoing")
    files.write_table(cleaning.rename_type(tx(spark, sf_dir)), path)
    write_jdbc(files.read_table(spark, path), url, TRANSFORMED_DATA, column_types=contract.TEXT_TYPES)
    split = split_by_key(spark, url, TRANSFORMED_DATA, "transactionID", _tasks(spark))
    return read_jdbc(spark, url, TRANSFORMED_DATA, split_by=split)


def jdbc_query(spark, sf_dir):
    url = spark.conf.get(_JDBC_URL_SETTING, _JDBC_URL)
    write_jdbc(metrics.fraud_by_type(_summary(spark, sf_dir)).coalesce(1), url, FRAUD_BY_TYPE)
    largest = f'(SELECT max("total_transactions") AS "largest_type" FROM {FRAUD_BY_TYPE}) counted'
    return read_jdbc(spark, url, largest)


def jdbc_balanced(spark, sf_dir):
    """A key that most rows share a small part of, read in balanced ranges, into which table the rows were loaded twice."""
    url = spark.conf.get(_JDBC_URL_SETTING, _JDBC_URL)
    path = scratch_path(spark, "outgoing")
    key = F.col("transactionID")
    rows = tx(spark, sf_dir).select(F.when(key % 10 < 9, key).otherwise(key * 1000).alias("key"), "amount")
    files.write_table(rows, path)
    for _ in range(2):
        write_jdbc(files.read_table(spark, path), url, "skewed_keys")
    reads = 8
    balanced = read_balanced(spark, url, "skewed_keys", "key", reads).withColumn("part", F.spark_partition_id())
    sizes = balanced.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("key").alias("keys"))
    total = F.sum("rows")
    return sizes.agg(
        total.alias("total_rows"), F.sum("keys").alias("key_sum"), (F.max("rows") * reads <= 2 * total).alias("balanced")
    )


def jdbc_publish(spark, sf_dir):
    """All four tables of a batch take their places at once; a load that fails on a row leaves them."""
    url = spark.conf.get(_JDBC_URL_SETTING, _JDBC_URL)
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    run_batch(positioned_tx(spark, sf_dir), landed, served, _batch_size(spark, sf_dir), 2, _keys(spark), partitions=_tasks(spark))
    tables = {name: read_published(spark, served, name) for name in SERVED_TABLES}
    publish_jdbc(tables, url, {})
    broken = F.when(F.col("total_flagged") >= 0, F.raise_error(F.lit("no such row"))).otherwise(F.col("total_flagged"))
    try:
        publish_jdbc(tables | {FLAGGED_FRAUD_ACCURACY: tables[FLAGGED_FRAUD_ACCURACY].withColumn("total_flagged", broken)}, url, {})
        failed = False
    except Exception:  # noqa: BLE001
        failed = True
    stored = _rounded(read_jdbc(spark, url, FRAUD_BY_TYPE), "fraud_rate")
    rows = read_jdbc(spark, url, TRANSFORMED_DATA).groupBy("transType").agg(F.count(F.lit(1)).alias("stored_rows"))
    return stored.join(rows, "transType").withColumn("failed", F.lit(failed))


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth row with a broken amount, another tenth with a broken time."""
    turn, rows = F.col("transactionID") % 10, tx(spark, sf_dir)
    amount = F.when(turn == 3, F.lit("12,x")).otherwise(F.col("amount").cast("string"))
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return rows.withColumns({"amount": amount, "timestamp": F.when(turn == 7, F.lit("soon")).otherwise(time)})


def csv_rejects(spark, sf_dir):
    """Rows and rejects of one pass over files, and of an arrival, by the key that their text holds."""
    source, keys = scratch_path(spark, "csv"), _keys(spark)
    files.write_csv(_planted(spark, sf_dir), source)
    staged = files.stage_csv_with_rejects(files.read_csv_with_rejects(spark, source), scratch_path(spark, "staged"))
    landed, checkpoint = (scratch_path(spark, name) for name in ("landed", "progress"))
    for _ in range(2):
        land_arrivals(read_arrivals(spark, source, rejects=True), landed, checkpoint, keys).awaitTermination()
    found = None
    for way, rows, rejects in (
        ("files", staged.rows, staged.rejects),
        ("arrivals", read_landed(spark, landed, keys), read_landed(spark, landed, keys, rejects=True)),
    ):
        text_key = F.split("line", ",")[1].cast("bigint")
        for part in (
            rows.select("transactionID", "amount", F.lit(False).alias("rejected")),
            rejects.select(text_key.alias("transactionID"), F.lit(None).cast("double").alias("amount"), F.lit(True).alias("rejected")),
        ):
            part = part.withColumn("way", F.lit(way))
            found = part if found is None else found.union(part)
    return found.withColumns(
        {"row_count": F.lit(staged.row_count).cast("bigint"), "reject_count": F.lit(staged.reject_count).cast("bigint")}
    )


def limit_prefix(spark, sf_dir):
    return batching.limit_prefix(positioned_tx(spark, sf_dir), 3 * _batch_size(spark, sf_dir))


def except_all(spark, sf_dir):
    batches = batching.fan_out(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), BATCH_COUNT).drop("batch")
    return batching.except_all(batches, tx(spark, sf_dir))


def batch_slice_by_key(spark, sf_dir):
    by_amount = stage_in_key_order(positioned_tx(spark, sf_dir), ["amount"], scratch_path(spark, "by-amount"))
    return batching.batch_slice(by_amount, _batch_size(spark, sf_dir), 2)


def batch_fanout(spark, sf_dir):
    return batching.fan_out(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), BATCH_COUNT)


def fan_out_many(spark, sf_dir):
    """A batch every ten rows, over the whole table."""
    return batching.fan_out(positioned_tx(spark, sf_dir), 10)


def batch_slice_indexed(spark, sf_dir):
    """Two batches of a staged table, whose stored index tells where they lie."""
    path, size = scratch_path(spark, "staged"), _batch_size(spark, sf_dir)
    stage_in_key_order(positioned_tx(spark, sf_dir), ["transactionID"], path)
    staged, index = spark.read.parquet(path), BlockIndex.load(spark, path)
    first, second = (batching.batch_slice(staged, size, number, index=index) for number in (2, 10))
    return first.withColumn("batch", F.lit(2)).union(second.withColumn("batch", F.lit(10)))


def batch_files(spark, sf_dir):
    """A hundred batches, each written as three files at most: the rows that are found again, and whether files are few."""
    rows, path = positioned_tx(spark, sf_dir), scratch_path(spark, "batches")
    index = BlockIndex.of(rows)
    size = max(1, index.rows // 99)
    batches = batching.count_batches(index.rows, size)
    segmented = batching.with_segment_rank(rows, size, batches + 1, index)
    fanned = segmented.withColumn("batch", F.explode(batching.batches_of(F.col("segment"), batches))).drop("segment")
    per_file = 2 * size // 3 + 1
    layout = Layout(fanned.groupBy("batch").agg(F.count(F.lit(1)).alias("rows")), rows_per_file=per_file)
    files.replace_partitions(layout.apply(fanned, F.col("_rank") - (F.col("batch") - 1) * size), path, "batch")
    found = files.read_table(spark, path).select("batch", F.col("_metadata.file_path").alias("file"))
    counted = found.groupBy("batch").agg(F.count(F.lit(1)).alias("batch_rows"), F.count_distinct("file").alias("files"))
    return counted.select("batch", "batch_rows", (F.col("files") <= F.ceil(F.col("batch_rows") / per_file)).alias("few_files"))


def drop_step(spark, sf_dir):
    return cleaning.drop_step(tx(spark, sf_dir))


def rename_type(spark, sf_dir):
    return cleaning.rename_type(tx(spark, sf_dir))


def cast_flags(spark, sf_dir):
    return cleaning.cast_flags(tx(spark, sf_dir))


def drop_null_label(spark, sf_dir):
    return cleaning.drop_null_labels(tx(spark, sf_dir))


def fraud_rows(spark, sf_dir):
    return metrics.fraud_rows(_cleaned(spark, sf_dir))


def dedup(spark, sf_dir):
    batches = batching.fan_out(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), BATCH_COUNT).drop("batch")
    return cleaning.drop_duplicates(batches)


def fraud_by_type(spark, sf_dir):
    return _rounded(metrics.fraud_by_type(_summary(spark, sf_dir)), "fraud_rate")


def fraud_stats(spark, sf_dir):
    return _rounded(metrics.fraud_stats(_summary(spark, sf_dir)), "avg_fraud_amount")


def flagged_fraud_accuracy(spark, sf_dir):
    return _rounded(metrics.flagged_fraud_accuracy(_summary(spark, sf_dir)), "flag_accuracy")


def encrypt_roundtrip(spark, sf_dir):
    keys = _keys(spark)
    return decrypt_columns(
        encrypt_columns(tx(spark, sf_dir).repartition(_tasks(spark)), PROTECTED_COLUMNS, keys), PROTECTED_COLUMNS, keys
    )


def encrypt_null(spark, sf_dir):
    keys = _keys(spark)
    known = tx(spark, sf_dir).withColumn("nameOrig", F.when(F.col("isFraud").isNotNull(), F.col("nameOrig")))
    tokens = encrypt_columns(known.repartition(_tasks(spark)), ["nameOrig"], keys).withColumn("has_token", F.col("nameOrig").isNotNull())
    return decrypt_columns(tokens, ["nameOrig"], keys).select("transactionID", "nameOrig", "has_token")


def decrypt_tamper(spark, sf_dir):
    """Damage the token of every row, in a way that depends on the type; only cash-outs stay as they are."""
    keys = _keys(spark)
    token, kind = F.col("nameOrig"), F.col("type")
    damaged = (
        F.when(kind == "PAYMENT", _flip(token, 60))
        .when(kind == "CASH_IN", _flip(token, 95))
        .when(kind == "TRANSFER", F.substring(token, 1, 40))
        .when(kind == "DEBIT", F.concat(F.lit("!"), token))
        .otherwise(token)
    )
    tokens = encrypt_columns(tx(spark, sf_dir).repartition(_tasks(spark)), ["nameOrig"], keys).withColumn("nameOrig", damaged)
    checked = with_token_check(tokens, "nameOrig", keys, "text", "valid")
    return checked.groupBy("type").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_if(~F.col("valid")).alias("rejected"),
        F.count("text").alias("readable"),
    )


def _flip(token: Column, at: int) -> Column:
    """The token with another character at one place."""
    other = F.when(F.substring(token, at, 1) == "A", F.lit("B")).otherwise(F.lit("A"))
    return F.overlay(token, other, F.lit(at))


def schema_check(spark, sf_dir):
    """Raw columns against the contract: one extra, one named otherwise."""
    return contract.schema_report(tx(spark, sf_dir))


def contract_conform(spark, sf_dir):
    return contract.conform(_cleaned(spark, sf_dir))


def contract_violations(spark, sf_dir):
    return contract.violations(_rule_breakers(spark, sf_dir))


def _rule_breakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each rule, by the last digits of the key; one column at a time."""
    turn = F.col("transactionID") % 20

    def broken(name, *values):
        column = F.col(name).cast("string")
        for number, value in values:
            column = F.when(turn == number, F.lit(value)).otherwise(column)
        return column

    rows = cleaning.rename_type(tx(spark, sf_dir))
    return rows.withColumns(
        {
            "transType": broken("transType", (0, "x" * 51), (1, None)),
            "amount": broken("amount", (2, "abc"), (3, "10000000000000"), (4, None)),
            "nameOrig": broken("nameOrig", (5, "x" * 60), (6, None)),
            "nameDest": broken("nameDest", (7, "x" * 51), (8, None)),
            "oldbalanceOrg": broken("oldbalanceOrg", (9, "1e14")),
            "isFlaggedFraud": broken("isFlaggedFraud", (10, None)),
            "isFraud": broken("isFraud", (11, "x")),
            "timestamp": broken("timestamp", (12, "soon"), (13, None)),
            "transactionID": broken("transactionID", (14, None)),
            "newbalanceOrig": broken("newbalanceOrig", (15, "1e14")),
            "oldbalanceDest": broken("oldbalanceDest", (16, "-1e14")),
            "newbalanceDest": broken("newbalanceDest", (17, "ten")),
        }
    )


def contract_duplicate_keys(spark, sf_dir):
    return contract.duplicate_keys(batching.fan_out(positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), BATCH_COUNT))


def scatter_points(spark, sf_dir):
    return serving.scatter_points(_cleaned(spark, sf_dir))


def scatter_amounts(spark, sf_dir):
    return serving.scatter_points(_cleaned(spark, sf_dir), "timestamp", "amount")


def scatter_sample(spark, sf_dir):
    return serving.scatter_sample(_cleaned(spark, sf_dir), "transactionID", "amount", points=1200, cells=8)


def scatter_sample_flags(spark, sf_dir):
    """The default chart."""
    return serving.scatter_sample(_cleaned(spark, sf_dir))


def chart_guard(spark, sf_dir):
    """What can be drawn of the cleaned table, of a batch behind its end, and of one without a column."""
    charts = {"scatter": ("transactionID", "isFraud"), "amounts": ("timestamp", "amount")}
    cleaned = _cleaned(spark, sf_dir)
    behind = cleaning.clean(cleaning.drop_step(_batch(11)(spark, sf_dir)))
    tables = {"whole": cleaned, "behind the end": behind, "without amounts": cleaned.drop("amount")}
    found = None
    for name, rows in tables.items():
        status = serving.chart_status(rows, charts).withColumn("table", F.lit(name))
        found = status if found is None else found.union(status)
    return found


def contract_watch(spark, sf_dir):
    """The rules that the written rows break, as counted while they were written."""
    watch = contract.Watch(_rule_breakers(spark, sf_dir))
    files.write_table(watch.rows, scratch_path(spark, "watched"))
    counted = [(rule, column, rows) for (rule, column), rows in watch.violations().items()]
    return spark.createDataFrame(counted, 'rule string, column string, violations bigint').coalesce(1)


def fraud_type_bars(spark, sf_dir):
    return serving.fraud_type_bars(metrics.fraud_by_type(_summary(spark, sf_dir)))


def clean(spark, sf_dir):
    keys = _keys(spark)
    return cleaning.clean(protect(tx(spark, sf_dir), keys, _tasks(spark)), keys)


def ingest_one_batch(spark, sf_dir):
    keys, landed = _keys(spark), scratch_path(spark, "landed")
    ingest_batch(positioned_tx(spark, sf_dir), landed, _batch_size(spark, sf_dir), 2, keys, partitions=_tasks(spark))
    return decrypt_columns(files.read_batch(spark, landed, 2), PROTECTED_COLUMNS, keys)


def ingest_all_batches(spark, sf_dir):
    keys, landed = _keys(spark), scratch_path(spark, "landed")
    size = _batch_size(spark, sf_dir)
    ingest_all(positioned_tx(spark, sf_dir), landed, size, keys, BATCH_COUNT, partitions=_tasks(spark))
    return decrypt_columns(spark.read.parquet(landed), PROTECTED_COLUMNS, keys)


def _served_batch(spark: SparkSession, sf_dir: str, number: int, table: str) -> DataFrame:
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    rows, size = positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir)
    run_batch(rows, landed, served, size, number, _keys(spark), partitions=_tasks(spark))
    return read_published(spark, served, table)


def transform_batch(spark, sf_dir):
    return _served_batch(spark, sf_dir, 2, TRANSFORMED_DATA)


def transform_batch_fraud_by_type(spark, sf_dir):
    return _rounded(_served_batch(spark, sf_dir, 2, FRAUD_BY_TYPE), "fraud_rate")


def transform_batch_empty(spark, sf_dir):
    return _served_batch(spark, sf_dir, 11, FLAGGED_FRAUD_ACCURACY)


def _served_all(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    rows, size = positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir)
    run_all(rows, landed, served, size, _keys(spark), BATCH_COUNT, partitions=_tasks(spark))
    return read_published(spark, served, table, history=True)


def all_batches(spark, sf_dir):
    return _served_all(spark, sf_dir, TRANSFORMED_DATA)


def all_batches_fraud_by_type(spark, sf_dir):
    return _rounded(_served_all(spark, sf_dir, FRAUD_BY_TYPE), "fraud_rate")


def all_batches_fraud_stats(spark, sf_dir):
    return _rounded(_served_all(spark, sf_dir, FRAUD_STATS), "avg_fraud_amount")


def all_batches_flagged_fraud_accuracy(spark, sf_dir):
    return _rounded(_served_all(spark, sf_dir, FLAGGED_FRAUD_ACCURACY), "flag_accuracy")


def _with_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Positioned rows, each third one three times in a row, and a size that makes 150 batches or a few less.

    Copies lie in one segment or across the border of two.
    """
    path = scratch_path(spark, "copies")
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("transactionID") % 3 == 0, 3).otherwise(1)))
    rows = positioned_tx(spark, sf_dir).withColumn("_copy", copies).drop("_copy")
    copied = stage_in_key_order(rows, ["transactionID"], path)
    return copied, max(1, copied.count() // 149)


def all_batches_complete(spark, sf_dir):
    """With no number of batches given, every row is in some batch, and copies go within each."""
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    rows, size = _with_copies(spark, sf_dir)
    run_all(rows, landed, served, size, _keys(spark), partitions=_tasks(spark))
    return read_published(spark, served, TRANSFORMED_DATA, history=True)


def transform_batch_copies(spark, sf_dir):
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    rows, size = _with_copies(spark, sf_dir)
    run_batch(rows, landed, served, 20 * size, 2, _keys(spark), partitions=_tasks(spark))
    return read_published(spark, served, TRANSFORMED_DATA)


def clean_copies(spark, sf_dir):
    return cleaning.clean(cleaning.drop_step(drop_position(_with_copies(spark, sf_dir)[0])))


def _published_twice(spark: SparkSession, sf_dir: str, history: bool) -> DataFrame:
    """Batches 1 and 10 one after the other, then batch 1 once more."""
    rows, size, keys = positioned_tx(spark, sf_dir), _batch_size(spark, sf_dir), _keys(spark)
    landed, served = scratch_path(spark, "landed"), scratch_path(spark, "served")
    index = BlockIndex.of(rows)
    for number in (1, 10, 1):
        run_batch(rows, landed, served, size, number, keys, partitions=_tasks(spark), index=index)
    return _rounded(read_published(spark, served, FRAUD_BY_TYPE, history), "fraud_rate")


def served_latest(spark, sf_dir):
    return _published_twice(spark, sf_dir, history=False)


def served_history(spark, sf_dir):
    return _published_twice(spark, sf_dir, history=True)


def _arrived(spark: SparkSession, sf_dir: str) -> tuple[str, TokenKeys]:
    """Four CSV files, two at a time; the second run finds nothing new."""
    keys = _keys(spark)
    source, landed, checkpoint = (scratch_path(spark, name) for name in ("arriving", "landed", "progress"))
    files.write_csv(tx(spark, sf_dir).repartition(4, "transactionID"), source)
    for _ in range(2):
        arriving = read_arrivals(spark, source, files_per_trigger=2)
        land_arrivals(arriving, landed, checkpoint, keys).awaitTermination()
    return landed, keys


def stream_ingest(spark, sf_dir):
    landed, keys = _arrived(spark, sf_dir)
    return _number_flags(decrypt_columns(spark.read.parquet(landed), PROTECTED_COLUMNS, keys))


def stream_fraud_by_type(spark, sf_dir):
    return _rounded(fraud_by_type_so_far(spark, *_arrived(spark, sf_dir)), "fraud_rate")


def stream_batches(spark, sf_dir):
    """Flagged transactions arrive first and become batch 1, all others become batch 2."""
    keys, source = _keys(spark), scratch_path(spark, "arriving")
    landed, served, checkpoint = (scratch_path(spark, name) for name in ("landed", "served", "progress"))
    for flag in (1, 0):
        files.write_csv(tx(spark, sf_dir).filter(F.col("isFlaggedFraud") == flag), f"{source}/flag={flag}")
        publish_arrivals(read_arrivals(spark, f"{source}/*"), landed, served, checkpoint, keys).awaitTermination()
    return _rounded(read_published(spark, served, FRAUD_BY_TYPE, history=True), "fraud_rate")


def stream_fraud_by_type_added(spark, sf_dir):
    """Four arrivals, each a batch of its own; their summaries are added up."""
    keys, source = _keys(spark), scratch_path(spark, "arriving")
    landed, served, checkpoint = (scratch_path(spark, name) for name in ("landed", "served", "progress"))
    for turn in range(4):
        files.write_csv(tx(spark, sf_dir).filter(F.col("transactionID") % 4 == turn), f"{source}/turn={turn}")
        publish_arrivals(read_arrivals(spark, f"{source}/*"), landed, served, checkpoint, keys).awaitTermination()
    return _rounded(fraud_by_type_of_batches(spark, served), "fraud_rate")


def _counted_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Half of the rows, then all of them with every third one twice, then nothing new."""
    keys, source = _keys(spark), scratch_path(spark, "arriving")
    landed, summaries, checkpoint = (scratch_path(spark, name) for name in ("landed", "summaries", "progress"))
    rows = tx(spark, sf_dir)
    turns = [rows.filter(F.col("transactionID") % 2 == 0), rows.union(rows.filter(F.col("transactionID") % 3 == 0)), None]
    for number, turn in enumerate(turns):
        if turn is not None:
            files.write_csv(turn, f"{source}/turn={number}")
        count_arrivals(read_arrivals(spark, f"{source}/*"), landed, summaries, checkpoint, keys).awaitTermination()
    return landed, summaries


def stream_dedup(spark, sf_dir):
    landed, _ = _counted_arrivals(spark, sf_dir)
    rows = decrypt_columns(spark.read.parquet(landed), PROTECTED_COLUMNS, _keys(spark))
    return _number_flags(rows.drop("batch"))


def stream_dedup_fraud_by_type(spark, sf_dir):
    _, summaries = _counted_arrivals(spark, sf_dir)
    return _rounded(fraud_by_type_counted(spark, summaries), "fraud_rate")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "row_count": row_count,
        "csv_ingest": csv_ingest,
        "csv_text_flags": csv_text_flags,
        "csv_inferred": csv_inferred,
        "csv_inferred_types": csv_inferred_types,
        "csv_batch_slice": csv_batch_slice,
        "parquet_roundtrip": parquet_roundtrip,
        "batch_read": batch_read,
        "jdbc_roundtrip": jdbc_roundtrip,
        "jdbc_query": jdbc_query,
        "jdbc_balanced": jdbc_balanced,
        "jdbc_publish": jdbc_publish,
        "csv_rejects": csv_rejects,
        "limit_prefix": limit_prefix,
        "except_all": except_all,
        "batch_slice": _batch(2),
        "batch_slice_tail": _batch(10),
        "batch_slice_past_end": _batch(11),
        "batch_slice_disjoint": _batch(2, span=1),
        "batch_slice_by_key": batch_slice_by_key,
        "batch_fanout": batch_fanout,
        "fan_out_many": fan_out_many,
        "batch_slice_indexed": batch_slice_indexed,
        "batch_files": batch_files,
        "drop_step": drop_step,
        "rename_type": rename_type,
        "cast_flags": cast_flags,
        "drop_null_label": drop_null_label,
        "fraud_rows": fraud_rows,
        "dedup": dedup,
        "fraud_by_type": fraud_by_type,
        "fraud_stats": fraud_stats,
        "flagged_fraud_accuracy": flagged_fraud_accuracy,
        "encrypt_roundtrip": encrypt_roundtrip,
        "encrypt_null": encrypt_null,
        "decrypt_tamper": decrypt_tamper,
        "schema_check": schema_check,
        "contract_conform": contract_conform,
        "contract_violations": contract_violations,
        "contract_watch": contract_watch,
        "contract_duplicate_keys": contract_duplicate_keys,
        "scatter_points": scatter_points,
        "scatter_amounts": scatter_amounts,
        "scatter_sample": scatter_sample,
        "scatter_sample_flags": scatter_sample_flags,
        "chart_guard": chart_guard,
        "fraud_type_bars": fraud_type_bars,
        "clean": clean,
        "ingest_batch": ingest_one_batch,
        "ingest_all_batches": ingest_all_batches,
        "transform_batch": transform_batch,
        "transform_batch_fraud_by_type": transform_batch_fraud_by_type,
        "transform_batch_empty": transform_batch_empty,
        "all_batches": all_batches,
        "all_batches_fraud_by_type": all_batches_fraud_by_type,
        "all_batches_fraud_stats": all_batches_fraud_stats,
        "all_batches_flagged_fraud_accuracy": all_batches_flagged_fraud_accuracy,
        "all_batches_complete": all_batches_complete,
        "transform_batch_copies": transform_batch_copies,
        "clean_copies": clean_copies,
        "served_latest": served_latest,
        "served_history": served_history,
        "stream_ingest": stream_ingest,
        "stream_fraud_by_type": stream_fraud_by_type,
        "stream_fraud_by_type_added": stream_fraud_by_type_added,
        "stream_batches": stream_batches,
        "stream_dedup": stream_dedup,
        "stream_dedup_fraud_by_type": stream_dedup_fraud_by_type,
    }
    if training_text:
        found |= training_text.queries() | {"pipeline": corpus_pipeline.run}
    return found


_TX = """
tx AS (
SELECT CAST(hour(ts) + 24 * (dayofyear(ts) - 1) + 1 AS INT) AS "step",
       event_id AS "transactionID",
       CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'CASH_IN' WHEN 'purchase' THEN 'TRANSFER'
                       WHEN 'signup' THEN 'DEBIT' ELSE 'CASH_OUT' END AS "type",
       value AS "amount",
       concat('C', user_id) AS "nameOrig",
       value * 2 AS "oldbalanceOrg",
       value AS "newbalanceOrig",
       concat('M', (user_id * 7) % 50) AS "nameDest",
       CAST(0 AS DOUBLE) AS "oldbalanceDest",
       value AS "newbalanceDest",
       CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INT) % 25 = 24 THEN NULL
            WHEN CAST(regexp_extract(props, '[0-9]+') AS INT) % 10 = 0 THEN 1 ELSE 0 END AS "isFraud",
       CASE WHEN value > 150 THEN 1 ELSE 0 END AS "isFlaggedFraud",
       ts AS "timestamp"
FROM events
),
numbered AS (
SELECT *, row_number() OVER (ORDER BY "transactionID") - 1 AS i, (SELECT count(*) // 10 FROM events) AS size FROM tx
),
fanned AS (
SELECT numbered.* EXCLUDE (i, size), CAST(b.batch AS INT) AS batch
FROM numbered JOIN (SELECT unnest(range(1, 13)) AS batch) b
  ON i >= (b.batch - 1) * size AND i < (b.batch + 1) * size
),
"all_clean" AS (
SELECT DISTINCT batch, * EXCLUDE (batch, "step", "type", "isFraud", "isFlaggedFraud"), "type" AS "transType",
       CAST("isFraud" AS BOOLEAN) AS "isFraud", CAST("isFlaggedFraud" AS BOOLEAN) AS "isFlaggedFraud"
FROM fanned WHERE "isFraud" IS NOT NULL
),
cleaned AS (
SELECT DISTINCT * EXCLUDE ("step", "type", "isFraud", "isFlaggedFraud"), "type" AS "transType",
       CAST("isFraud" AS BOOLEAN) AS "isFraud", CAST("isFlaggedFraud" AS BOOLEAN) AS "isFlaggedFraud"
FROM tx WHERE "isFraud" IS NOT NULL
)
"""

_BY_TYPE = """
       "transType", count(*) AS total_transactions,
       CAST(sum(CAST("isFraud" AS INT)) AS BIGINT) AS fraudulent_transactions,
       round(sum(CAST("isFraud" AS INT)) / count(*) * 100, 6) AS fraud_rate
"""
_STATS = """
       round(avg(CASE WHEN "isFraud" THEN amount END), 6) AS avg_fraud_amount,
       max(CASE WHEN "isFraud" THEN amount END) AS max_fraud_amount
"""
_ACCURACY = """
       CAST(sum(CAST("isFlaggedFraud" AS BIGINT)) AS BIGINT) AS total_flagged,
       CAST(sum(CAST("isFlaggedFraud" AS BIGINT) * CAST("isFraud" AS BIGINT)) AS BIGINT) AS true_positive_flags,
       round(sum(CAST("isFlaggedFraud" AS BIGINT) * CAST("isFraud" AS BIGINT))
             / nullif(sum(CAST("isFlaggedFraud" AS BIGINT)), 0) * 100, 6) AS flag_accuracy
"""
_RANGE = 'SELECT * EXCLUDE (i, size) FROM numbered WHERE i >= {first} * size AND i < {past} * size'
_EVERY_BATCH = "(SELECT CAST(unnest(range(1, 13)) AS INT) AS batch)"


_VIOLATIONS = """
SELECT r."rule", r."column", CAST(count(t.k) AS BIGINT) AS violations
FROM (VALUES ('type', 'transactionID', []), ('type', 'transType', []), ('type', 'amount', [2, 3]),
             ('type', 'nameOrig', []), ('type', 'oldbalanceOrg', [9]), ('type', 'newbalanceOrig', [15]),
             ('type', 'nameDest', []), ('type', 'oldbalanceDest', [16]), ('type', 'newbalanceDest', [17]),
             ('type', 'isFraud', [11]), ('type', 'isFlaggedFraud', []), ('type', 'timestamp', [12]),
             ('not_null', 'transactionID', [14]), ('not_null', 'transType', [1]), ('not_null', 'amount', [4]),
             ('not_null', 'nameOrig', [6]), ('not_null', 'nameDest', [8]), ('not_null', 'isFraud', [-1]),
             ('not_null', 'isFlaggedFraud', [10]), ('not_null', 'timestamp', [13]),
             ('max_length', 'transType', [0]), ('max_length', 'nameOrig', [5]), ('max_length', 'nameDest', [7])
     ) AS r("rule", "column", turns)
LEFT JOIN (SELECT "transactionID" % 20 AS k FROM tx
           UNION ALL SELECT -1 FROM tx WHERE "isFraud" IS NULL AND "transactionID" % 20 <> 11) t
  ON list_contains(r.turns, t.k)
GROUP BY r."rule", r."column"
"""
# The steps of the axes are floors of shares, the last one closed; slots are dealt by the hash of the key.
_SAMPLE = """
SELECT {x}, {y}, cell_rows FROM (
    SELECT *, CAST(count(*) OVER (PARTITION BY x_cell, y_cell) AS BIGINT) AS cell_rows,
           row_number() OVER (PARTITION BY x_cell, y_cell, h % {slots} ORDER BY h) AS place
    FROM (
        SELECT {x}, {y}, CAST('0x' || substr(md5(CAST("transactionID" AS VARCHAR)), 1, 15) AS BIGINT) AS h,
               least({x_steps} - 1, floor(({x_place} - min({x_place}) OVER ())
                     / ((max({x_place}) OVER () - min({x_place}) OVER ()) / {x_steps}))) AS x_cell,
               least({y_steps} - 1, floor(({y_place} - min({y_place}) OVER ())
                     / ((max({y_place}) OVER () - min({y_place}) OVER ()) / {y_steps}))) AS y_cell
        FROM cleaned))
WHERE place = 1
"""
_COPIED = """
copied AS (
SELECT *, row_number() OVER (ORDER BY "transactionID") - 1 AS j
FROM tx JOIN (SELECT unnest(range(3)) AS copy) c ON c.copy = 0 OR "transactionID" % 3 = 0
),
copied_size AS (SELECT greatest(1, count(*) // 149) AS size FROM copied),
in_batches AS (
SELECT DISTINCT CAST(batch AS INT) AS batch, "transactionID"
FROM (SELECT "transactionID", unnest([j // size, j // size + 1]) AS batch FROM copied, copied_size), copied_size s
WHERE batch >= 1 AND (batch - 1) * s.size < (SELECT count(*) FROM copied)
)
"""


def oracle_sql() -> dict[str, str]:
    batch_2 = _RANGE.format(first=1, past=3)
    statements = {
        "row_count": "SELECT count(*) AS total_rows FROM tx",
        "csv_ingest": "SELECT * FROM tx",
        "csv_text_flags": """
            SELECT * REPLACE (CASE WHEN "transactionID" % 4 < 3 THEN "isFraud" END AS "isFraud",
                   CASE WHEN "transactionID" % 4 < 3 THEN "isFlaggedFraud" END AS "isFlaggedFraud") FROM cleaned""",
        "csv_inferred": "SELECT * FROM tx",
        "csv_inferred_types": """
            SELECT * FROM (VALUES ('step', 'int'), ('transactionID', 'int'), ('type', 'string'), ('amount', 'double'),
                ('nameOrig', 'string'), ('oldbalanceOrg', 'double'), ('newbalanceOrig', 'double'), ('nameDest', 'string'),
                ('oldbalanceDest', 'double'), ('newbalanceDest', 'double'), ('isFraud', 'int'), ('isFlaggedFraud', 'int'),
                ('timestamp', 'timestamp')) AS t("column", "type")
            WHERE (SELECT count(*) FROM tx) > 0""",
        "csv_batch_slice": batch_2,
        "parquet_roundtrip": "SELECT * FROM tx",
        "batch_read": batch_2,
        "jdbc_roundtrip": 'SELECT * EXCLUDE ("type"), "type" AS "transType" FROM tx',
        "jdbc_balanced": """
            SELECT count(*) AS total_rows, TRUE AS balanced, CAST(sum(
                CASE WHEN "transactionID" % 10 < 9 THEN "transactionID" ELSE "transactionID" * 1000 END) AS BIGINT) AS key_sum FROM tx""",
        "jdbc_publish": f"""
            SELECT {_BY_TYPE}, count(*) AS stored_rows, TRUE AS failed FROM all_clean WHERE batch = 2 GROUP BY "transType" """,
        "csv_rejects": """
            SELECT "transactionID", CASE WHEN NOT rejected THEN "amount" END AS "amount", rejected, way,
                   count(*) FILTER (NOT rejected) OVER () // 2 AS row_count, count(*) FILTER (rejected) OVER () // 2 AS reject_count
            FROM (SELECT *, "transactionID" % 10 IN (3, 7) AS rejected, unnest(['files', 'arrivals']) AS way FROM tx)""",
        "jdbc_query": 'SELECT max(n) AS "largest_type" FROM (SELECT count(*) AS n FROM cleaned GROUP BY "transType")',
        "limit_prefix": _RANGE.format(first=0, past=3),
        "except_all": "SELECT * EXCLUDE (batch) FROM fanned EXCEPT ALL SELECT * FROM tx",
        "batch_slice": batch_2,
        "batch_slice_tail": _RANGE.format(first=9, past=11),
        "batch_slice_past_end": _RANGE.format(first=10, past=12),
        "batch_slice_disjoint": _RANGE.format(first=1, past=2),
        "batch_slice_by_key": """
            SELECT * EXCLUDE (i, size, k) FROM (
                SELECT *, row_number() OVER (ORDER BY "amount" NULLS FIRST, i) - 1 AS k FROM numbered)
            WHERE k >= size AND k < 3 * size""",
        "batch_fanout": "SELECT * FROM fanned",
        "fan_out_many": """
            SELECT * EXCLUDE (i, size, batch), CAST(batch AS INT) AS batch
            FROM (SELECT *, unnest([i // 10, i // 10 + 1]) AS batch FROM numbered)
            WHERE batch >= 1 AND (batch - 1) * 10 < (SELECT count(*) FROM tx)""",
        "batch_slice_indexed": "SELECT * FROM fanned WHERE batch IN (2, 10)",
        "batch_files": """
            SELECT CAST(batch AS INT) AS batch, count(*) AS batch_rows, TRUE AS few_files
            FROM (SELECT n, unnest([i // n, i // n + 1]) AS batch
                  FROM (SELECT i, greatest(1, (SELECT count(*) // 99 FROM tx)) AS n FROM numbered))
            WHERE batch >= 1 AND (batch - 1) * n < (SELECT count(*) FROM tx) GROUP BY batch""",
        "drop_step": 'SELECT * EXCLUDE ("step") FROM tx',
        "rename_type": 'SELECT * EXCLUDE ("type"), "type" AS "transType" FROM tx',
        "cast_flags": """
            SELECT * EXCLUDE ("isFraud", "isFlaggedFraud"), CAST("isFraud" AS BOOLEAN) AS "isFraud",
                   CAST("isFlaggedFraud" AS BOOLEAN) AS "isFlaggedFraud" FROM tx""",
        "drop_null_label": 'SELECT * FROM tx WHERE "isFraud" IS NOT NULL',
        "fraud_rows": 'SELECT * FROM cleaned WHERE "isFraud"',
        "dedup": "SELECT DISTINCT * EXCLUDE (batch) FROM fanned",
        "fraud_by_type": f'SELECT {_BY_TYPE} FROM cleaned GROUP BY "transType"',
        "fraud_stats": f"SELECT {_STATS} FROM cleaned",
        "flagged_fraud_accuracy": f"SELECT {_ACCURACY} FROM cleaned",
        "encrypt_roundtrip": "SELECT * FROM tx",
        "encrypt_null": """
            SELECT "transactionID", CASE WHEN "isFraud" IS NOT NULL THEN "nameOrig" END AS "nameOrig",
                   "isFraud" IS NOT NULL AS has_token FROM tx""",
        "decrypt_tamper": """
            SELECT "type", count(*) AS tokens, count(CASE WHEN "type" <> 'CASH_OUT' THEN 1 END) AS rejected,
                   count(CASE WHEN "type" = 'CASH_OUT' THEN 1 END) AS readable FROM tx GROUP BY "type" """,
        "schema_check": """
            SELECT column_name AS "column", CASE column_name WHEN 'transType' THEN 'missing' WHEN 'step' THEN 'extra'
                   WHEN 'type' THEN 'extra' ELSE 'ok' END AS status,
                   CASE column_name WHEN 'transType' THEN 0 WHEN 'isFraud' THEN (SELECT count("isFraud") FROM tx)
                   ELSE (SELECT count(*) FROM tx) END AS "values"
            FROM (SELECT unnest(['step', 'transactionID', 'type', 'amount', 'nameOrig', 'oldbalanceOrg',
                   'newbalanceOrig', 'nameDest', 'oldbalanceDest', 'newbalanceDest', 'isFraud', 'isFlaggedFraud',
                   'timestamp', 'transType']) AS column_name)""",
        "contract_conform": """
            SELECT * REPLACE (CAST("amount" AS DECIMAL(15,2)) AS "amount",
                   CAST("oldbalanceOrg" AS DECIMAL(15,2)) AS "oldbalanceOrg",
                   CAST("newbalanceOrig" AS DECIMAL(15,2)) AS "newbalanceOrig",
                   CAST("oldbalanceDest" AS DECIMAL(15,2)) AS "oldbalanceDest",
                   CAST("newbalanceDest" AS DECIMAL(15,2)) AS "newbalanceDest") FROM cleaned""",
        "contract_violations": _VIOLATIONS,
        "contract_watch": _VIOLATIONS,
        "contract_duplicate_keys": """
            SELECT "transactionID", count(*) AS "rows" FROM fanned GROUP BY "transactionID" HAVING count(*) > 1""",
        "scatter_points": 'SELECT "transactionID", "isFraud" FROM cleaned',
        "scatter_amounts": 'SELECT "timestamp", "amount" FROM cleaned',
        "scatter_sample": _SAMPLE.format(
            x='"transactionID"', y='"amount"', x_place='"transactionID"::DOUBLE', y_place='"amount"', x_steps=8, y_steps=8, slots=1200 // 81),
        "scatter_sample_flags": _SAMPLE.format(
            x='"transactionID"', y='"isFraud"', x_place='"transactionID"::DOUBLE', y_place='"isFraud"::INT::DOUBLE',
            x_steps=16, y_steps=2, slots=1024 // 51),
        "chart_guard": """
            SELECT chart, "table", CASE WHEN "table" = 'without amounts' AND chart = 'amounts' THEN 'missing column'
                   WHEN "table" = 'behind the end' OR (SELECT count(*) FROM cleaned) = 0 THEN 'empty' ELSE 'ready' END AS status
            FROM (SELECT unnest(['whole', 'behind the end', 'without amounts']) AS "table"),
                 (SELECT unnest(['scatter', 'amounts']) AS chart)""",
        "fraud_type_bars": """
            SELECT "transType", CAST(sum(CAST("isFraud" AS INT)) AS BIGINT) AS fraudulent_transactions
            FROM cleaned GROUP BY "transType" """,
        "clean": "SELECT * FROM cleaned",
        "ingest_batch": f'SELECT * EXCLUDE ("step") FROM ({batch_2})',
        "ingest_all_batches": 'SELECT * EXCLUDE (i, size, "step"), CAST(i // size AS INT) AS segment FROM numbered WHERE i < 13 * size',
        "transform_batch": "SELECT * EXCLUDE (batch) FROM all_clean WHERE batch = 2",
        "transform_batch_fraud_by_type": f'SELECT {_BY_TYPE} FROM all_clean WHERE batch = 2 GROUP BY "transType"',
        "transform_batch_empty": f"SELECT {_ACCURACY} FROM all_clean WHERE batch = 11",
        "all_batches": "SELECT * FROM all_clean",
        "all_batches_fraud_by_type": f'SELECT batch, {_BY_TYPE} FROM all_clean GROUP BY batch, "transType"',
        "all_batches_fraud_stats": f"""
            SELECT batch, {_STATS} FROM {_EVERY_BATCH} LEFT JOIN all_clean USING (batch) GROUP BY batch""",
        "all_batches_flagged_fraud_accuracy": f"""
            SELECT batch, {_ACCURACY} FROM {_EVERY_BATCH} LEFT JOIN all_clean USING (batch) GROUP BY batch""",
        "all_batches_complete": 'SELECT cleaned.*, batch FROM in_batches JOIN cleaned USING ("transactionID")',
        "transform_batch_copies": """
            SELECT * FROM cleaned WHERE "transactionID" IN (
                SELECT "transactionID" FROM copied, copied_size s WHERE j >= 20 * s.size AND j < 60 * s.size)""",
        "clean_copies": "SELECT * FROM cleaned",
        "served_latest": f'SELECT {_BY_TYPE} FROM all_clean WHERE batch = 1 GROUP BY "transType"',
        "served_history": f"""
            SELECT batch, {_BY_TYPE} FROM all_clean WHERE batch IN (1, 10) GROUP BY batch, "transType" """,
        "stream_ingest": 'SELECT * EXCLUDE ("step") FROM tx',
        "stream_dedup": 'SELECT * EXCLUDE ("step") FROM tx',
        "stream_dedup_fraud_by_type": f'SELECT {_BY_TYPE} FROM cleaned GROUP BY "transType"',
        "stream_fraud_by_type": f'SELECT {_BY_TYPE} FROM cleaned GROUP BY "transType"',
        "stream_fraud_by_type_added": f'SELECT {_BY_TYPE} FROM cleaned GROUP BY "transType"',
        "stream_batches": f"""
            SELECT batch, {_BY_TYPE} FROM (SELECT *, CASE WHEN "isFlaggedFraud" THEN 1 ELSE 2 END AS batch FROM cleaned)
            GROUP BY batch, "transType" """,
    }
    found = {name: f"WITH {_TX}, {_COPIED} {statement}" for name, statement in statements.items()}
    if training_text:
        found |= training_text.oracle_sql()
    return found
