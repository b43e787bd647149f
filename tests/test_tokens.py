import base64
import glob

import pytest
from pyspark.sql import functions as F

from tallymill.fixtures import tx
from tallymill.functions.tokens import TokenKeys, decrypt_columns, encrypt_columns, with_token_check

# The published test vector.
KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
TOKEN = "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64jVmpU4IwqDA=="
SECONDS = 499162800


@pytest.fixture(scope="module")
def keys(spark):
    return TokenKeys.from_text(spark, KEY)


def frame(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "name string")


def test_published_token_is_made(spark, keys):
    made = encrypt_columns(
        frame(spark, "hello"),
        ["name"],
        keys,
        iv=F.unhex(F.lit(bytes(range(16)).hex())),
        seconds=F.lit(SECONDS).cast("bigint"),
    )
    assert made.first()["name"] == TOKEN


def test_published_token_is_read(spark, keys):
    assert decrypt_columns(frame(spark, TOKEN), ["name"], keys).first()["name"] == "hello"


def test_damaged_tokens_are_told_apart(spark, keys):
    other_key = TokenKeys.from_text(spark, base64.urlsafe_b64encode(bytes(range(32))).decode())
    damaged = [TOKEN[:60] + "A" + TOKEN[61:], TOKEN[:-4] + "A" + TOKEN[-3:], "gAAA", "!!notbase64!!", "", "hB" + TOKEN[2:]]
    tokens = frame(spark, TOKEN, None, *damaged)
    checked = with_token_check(tokens, "name", keys, "text", "valid")
    assert checked.columns == ["name", "text", "valid"]
    found = [(row["text"], row["valid"]) for row in checked.collect()]
    assert found == [("hello", True), (None, None)] + [(None, False)] * len(damaged)
    assert with_token_check(frame(spark, TOKEN), "name", other_key, "text", "valid").first()["valid"] is False


@pytest.mark.parametrize("token", ["gAAA", "!!notbase64!!", TOKEN[:60] + "A" + TOKEN[61:]])
def test_a_bad_token_fails_the_job(spark, keys, token):
    with pytest.raises(Exception, match="column name holds a token that is not valid"):
        decrypt_columns(frame(spark, TOKEN, token), ["name"], keys).collect()


def test_all_kinds_of_text_come_back(spark, keys):
    texts = [None, "", "C1", "x" * 15, "x" * 16, "x" * 17, "Zoë – 口座 😀", "long " * 500]
    tokens = encrypt_columns(frame(spark, *texts), ["name"], keys)
    stored = [row["name"] for row in tokens.collect()]
    assert stored[0] is None
    assert all("\n" not in token and "+" not in token and "/" not in token for token in stored[1:])
    again = spark.createDataFrame([(token,) for token in stored], "name string")
    assert [row["name"] for row in decrypt_columns(again, ["name"], keys).collect()] == texts


def test_stored_tokens_differ_and_come_back(spark, keys, sf_dir, tmp_path):
    rows = tx(spark, sf_dir)
    encrypt_columns(rows, ["nameOrig", "nameDest"], keys).write.parquet(str(tmp_path / "tokens"))
    stored = spark.read.parquet(str(tmp_path / "tokens"))
    total = rows.count()
    assert stored.select("nameOrig").distinct().count() == total
    assert stored.select("nameDest").union(stored.select("nameOrig")).distinct().count() == 2 * total
    back = decrypt_columns(stored, ["nameOrig", "nameDest"], keys)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_a_token_survives_rewrites_of_the_plan(spark, keys, sf_dir):
    tokens = encrypt_columns(tx(spark, sf_dir), ["nameOrig"], keys)
    twice = tokens.select(F.col("nameOrig").alias("a"), F.concat("nameOrig", F.lit("")).alias("b"))
    assert twice.filter(F.col("a").startswith("gAAAA") & (F.length("b") > 10)).filter("a <> b").isEmpty()


def test_tokens_use_no_python_workers_and_hide_the_key(spark, keys, sf_dir):
    rows = encrypt_columns(tx(spark, sf_dir), ["nameOrig"], keys)
    checked = with_token_check(rows, "nameOrig", keys, "text", "valid")
    raw = base64.urlsafe_b64decode(KEY)
    pads = [bytes(byte ^ mask for byte in raw[:16]) for mask in (0x36, 0x5C)]
    secrets = [secret for value in (raw[:16], raw[16:], *pads) for secret in _spellings(value)]
    checked.collect()
    for mode in ("simple", "extended", "formatted", "codegen"):
        plan = checked._sc._jvm.PythonSQLUtils.explainString(checked._jdf.queryExecution(), mode)
        assert "Python" not in plan
        assert not [secret for secret in secrets if secret in plan.lower()]


def _spellings(value):
    """Ways in which a plan may print bytes, in lower case."""
    signed = [str(byte - 256 if byte > 127 else byte) for byte in value]
    return [
        value.hex(),
        " ".join(f"{byte:02x}" for byte in value),
        base64.b64encode(value).decode().lower(),
        ", ".join(signed),
        ",".join(signed),
    ]


def test_event_log_hides_the_key(tmp_path):
    """In a session of its own, as the log is a setting of the session."""
    import subprocess
    import sys

    script = f"""
from pyspark.sql import SparkSession
from tallymill.functions.tokens import TokenKeys, encrypt_columns
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "{tmp_path}")
    .config("spark.eventLog.compress", "false").getOrCreate())
keys = TokenKeys.from_text(spark, "{KEY}")
names = spark.range(100).selectExpr("concat('C', id) AS name")
encrypt_columns(names, ["name"], keys).write.format("noop").mode("overwrite").save()
spark.stop()
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=".", timeout=120)
    logs = [path for path in glob.glob(f"{tmp_path}/**", recursive=True) if "events" in path or "local-" in path]
    text = ""
    for path in logs:
        try:
            with open(path) as log:
                text += log.read().lower()
        except IsADirectoryError:
            continue
    assert "aesencrypt" in text
    raw = base64.urlsafe_b64decode(KEY)
    assert KEY.lower() not in text
    assert not [secret for part in (raw[:16], raw[16:]) for secret in _spellings(part) if secret in text]


@pytest.mark.parametrize("key", ["", "short", base64.urlsafe_b64encode(bytes(31)).decode(), "ü" * 44])
def test_a_key_of_another_size_is_refused(spark, key):
    with pytest.raises(ValueError):
        TokenKeys.from_text(spark, key)


def test_key_from_the_environment(spark, monkeypatch):
    monkeypatch.setenv("ENCRYPTION_KEY", KEY)
    keys = TokenKeys.from_environment(spark)
    assert decrypt_columns(frame(spark, TOKEN), ["name"], keys).first()["name"] == "hello"
    assert KEY not in repr(keys)
    monkeypatch.delenv("ENCRYPTION_KEY")
    with pytest.raises(ValueError):
        TokenKeys.from_environment(spark)
