"""Phrases against plain counting, and the index against plain search."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tallymill.llm.collocations import collocations
from tallymill.llm.fm_index import PhraseIndex
from tallymill.llm.queries import op13_phrase_collocations, oracle_sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=5, top=2000):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            of.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    result = []
    for lang, of in counts.items():
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        inside = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if p[i:j] != p and 100 * a >= 100 * of[p[i:j]]
        }
        found = []
        for p, a in candidates.items():
            if p not in inside:
                cuts = [(1000 * a * sizes[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(result)


def test_index_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        ids = rng.integers(0, 4, rng.integers(0, 60)).astype(np.uint32)

        def grams(k, ids=ids):
            return Counter(tuple(map(int, ids[i : i + k])) for i in range(len(ids) - k + 1) if all(ids[i : i + k]))

        for k in range(2, 6):
            index = PhraseIndex(ids, k)
            shorter = [*grams(k - 1)]
            first = [next(i for i in range(len(ids)) if tuple(ids[i : i + k - 1]) == p) for p in shorter]
            ranges = index.find(np.array(first, int), k - 1)
            assert dict(zip(shorter, ranges.size.tolist(), strict=True)) == grams(k - 1)
            right, left = index.extend_right(ranges), index.extend_left(ranges)
            by_right = [(*shorter[p], w) for p, w in zip(right.parent.tolist(), right.word.tolist(), strict=True)]
            by_left = [(w, *shorter[p]) for p, w in zip(left.parent.tolist(), left.word.tolist(), strict=True)]
            assert dict(zip(by_right, right.ranges.size.tolist(), strict=True)) == grams(k)
            for name in ("forward", "backward", "size"):
                values = [dict(zip(n, getattr(x.ranges, name).tolist(), strict=True)) for n, x in ((by_right, right), (by_left, left))]
                assert values[0] == values[1]
            for phrase, place in zip(by_right, index.place(right.ranges).tolist(), strict=True):
                assert tuple(ids[place : place + k]) == phrase


def test_whole_table_by_sql_and_plain_counting(spark, sf_dir):
    found = sorted(map(tuple, op13_phrase_collocations(spark, sf_dir).collect()))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    assert found == plain(rows, 100)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        assert sorted(connection.sql(oracle_sql()["op13_phrase_collocations"]).fetchall()) == found


@pytest.mark.parametrize("shard_bytes", [1, 1 << 14, 1 << 24])
def test_any_shards_give_the_same(spark, sf_dir, shard_bytes):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert sorted(map(tuple, collocations(docs.repartition(3), least=3, shard_bytes=shard_bytes).collect())) == plain(rows, 3)


def test_nulls_ties_long_texts_and_clashing_names(spark):
    rows = [
        (None, "A b. a\tB! a b c d e f"),
        ("und", "a b c d e f, É é"),
        ("x", None),
        ("x", ""),
        ("x", "q q q q q q q"),
        ("", "one two " * 30_000),
        ("", "two\x0bone one\x85two"),
    ]
    docs = spark.createDataFrame([(*row, 1, "s", 3) for row in rows], "lang string, text string, n int, word string, shard int")
    for least, top in ((1, 2000), (2, 3)):
        assert sorted(map(tuple, collocations(docs, least=least, top=top).collect())) == plain(rows, least, top=top)
    assert collocations(docs.limit(0)).collect() == []
    assert collocations(docs, least=10**6).collect() == []
