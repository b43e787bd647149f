import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from tallymill.llm import exact, queries

SCHEMA = "doc_id bigint, text string, digest string, row string"


def normal(text):
    return (text or "").encode().lower()


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    found = []
    for text, ids in groups.items():
        known = [x for x in ids if x is not None]
        found += [(x, max(known, default=None), len(ids), hashlib.sha256(text).hexdigest()) for x in ids]
    return sorted(found, key=str)


ROWS = [
    (1, "Abc"),
    (2, "aBC"),
    (3, "abc "),
    (4, "É"),
    (5, "é"),
    (6, None),
    (7, ""),
    (None, "abc"),
    (None, "alone"),
    (8, "word " * 50_000),
    (9, "WORD " * 50_000),
    (9, "word " * 50_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("copies", [0, 3000])
def test_groups_agree_with_brute_force(spark, copies):
    rows = ROWS + [(100 + i, "Copy") for i in range(copies)] + [(9000 + i, f"other {i}") for i in range(copies)]
    found = exact.exact_groups(frame(spark, rows).repartition(7)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(rows)
    kept = defaultdict(int)
    for r in found:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_heavy_digests_are_found_whatever_the_partitions(spark):
    rows = [("hot" if i % 3 == 0 else f"cold {i}", i) for i in range(6000)]
    df = spark.createDataFrame([(i, d, i) for d, i in rows], "doc_id bigint, digest string, row bigint")
    for parts in (1, 40):
        winners = exact.heavy_winners(df.repartition(parts), share=0.1, counters=39).collect()
        assert [(w.digest, w["size"], w.winner.doc_id) for w in winners] == [("hot", 2000, 5997)]


def test_summaries_fall_short_by_a_bound():
    rng = np.random.default_rng(1)
    items = pd.Series(rng.zipf(1.3, 20_000).clip(max=5000).astype(str))
    batches = [pd.DataFrame({"digest": items[i : i + 700]}) for i in range(0, len(items), 700)]
    (summary,) = exact.misra_gries(iter(batches), 50)
    assert len(summary) <= 50
    held = summary.set_index("digest")["least"]
    for item, count in items.value_counts().items():
        assert count - len(items) / 51 <= held.get(item, 0) <= count


def test_empty_table(spark):
    assert exact.exact_groups(frame(spark, [])).collect() == []
    assert exact.drop_exact_copies(frame(spark, [])).collect() == []


def test_stage_keeps_one_row_of_each_text_with_its_columns(spark):
    docs = frame(spark, ROWS + [(8, "word " * 50_000)])
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id or -1, (r.text or "")[:9]) for r in kept.collect())
    assert texts == [(-1, "alone"), (2, "aBC"), (3, "abc "), (4, "É"), (5, "é"), (7, ""), (9, texts[-1][1])]
    assert texts[-1][1].lower() == "word word"


def test_query_agrees_with_sql(spark, sf_dir):
    duckdb.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql = duckdb.sql(queries.oracle_sql()["op3_exact_dedup"])
    found = queries.op3_exact_dedup(spark, sf_dir).select(*sql.columns)
    assert sorted(map(tuple, found.collect())) == sorted(sql.fetchall())
