"""The pipeline against its stages in plain Python, and rows that are easy to lose or to break on."""

import hashlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallymill.llm import quality
from tallymill.llm.components import components

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(docs):
    """Of equal texts the row with the largest id; ids are not null here."""
    last = {}
    for doc in docs:
        key = (doc["text"] or "").translate(LOWER)
        if key not in last or doc["doc_id"] > last[key]["doc_id"]:
            last[key] = doc
    return [*last.values()]


def fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def near(docs):
    """Of each group of fingerprints that are linked, the document with the smallest id."""
    prints = [fingerprint(doc["text"]) for doc in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group[root(i)] = root(j)
    first = {}
    for i, doc in enumerate(docs):
        if root(i) not in first or doc["doc_id"] < first[root(i)]["doc_id"]:
            first[root(i)] = doc
    return [*first.values()]


def ids(rows):
    return sorted(row["doc_id"] for row in rows)


def test_stages_one_after_the_other(spark, sf_dir):
    """Each stage on what its predecessor kept; the last one holds all that was left, token by token."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_classifier"](spark, docs, sf_dir)
    kept = {row["doc_id"] for row in quality.judge(docs).filter("good").collect()}
    rows = [row.asDict() for row in docs.collect() if row["doc_id"] in kept]
    assert ids(good.collect()) == ids(rows)
    for name, plain in (("exact_dedup", exact), ("simhash_near_dedup", near)):
        rows = plain(rows)
        good = stages[name](spark, good, sf_dir)
        assert good.columns == docs.columns
        assert ids(good.collect()) == ids(rows), name
    clean = stages["benchmark_decontamination"](spark, good, sf_dir)
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    gone = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in left}
    assert clean.columns == docs.columns and gone and set(left) < set(ids(rows))
    assert all(not any(item and item in (text or "") for item in items) for text in left.values())
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {row["doc_id"] for row in packed} == set(left)
    lengths, totals = defaultdict(int), {}
    for row in packed:
        lengths[row["doc_id"]] += row["length"]
        totals[row["doc_id"]] = row["doc_tokens"]
    assert lengths == totals


CLASHES = ["_kept_id", "_kept_digest", "_kept_mark", "_hit_id", "_hit_mark", "_own_digest", "_own_mark", "key", "doc", "id", "mark", "fp", "root", "digest", "row"]


def odd_rows(spark, sf_dir):
    """Documents with nulls in every column, empty and very long texts, and rows that repeat."""
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    long = " ".join(t for _, t, *_ in docs if t) * 20
    odd = [(None, docs[0][1], None, None, None), (None, docs[0][1], None, None, None), (10**6, None, "en", "s", None), (10**6 + 1, "", None, None, 0)]
    return docs + docs[:5] + odd + [(10**6 + 2, long, "en", "s", len(long)), (None, None, None, None, None)]


def test_odd_rows_and_clashing_names_go_through_every_stage(spark, sf_dir):
    rows = odd_rows(spark, sf_dir)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs = docs.select("*", *[F.concat(F.lit(f"{name}:"), F.col("doc_id").cast("string")).alias(name) for name in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns, name
        collected = found.collect()
        assert all(row["fp"] is None if row["doc_id"] is None else row["fp"] == f"fp:{row['doc_id']}" for row in collected), name
        if name == "exact_dedup":
            texts = [hashlib.sha256((row["text"] or "").translate(LOWER).encode()).digest() for row in collected]
            assert len(texts) == len(set(texts)) == len({(r[1] or "").translate(LOWER) for r in rows})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == len({r[0] for r in rows})


def test_an_empty_table(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("shape", ["ascending path", "shuffled path", "star", "combs"])
def test_components_take_few_rounds(spark, shape, monkeypatch):
    import random

    from tallymill.llm import components as module

    count = 300
    names = list(range(count))
    if shape == "shuffled path":
        random.Random(2).shuffle(names)
    pairs = {
        "star": [(count, i) for i in range(count)],
        "combs": [(i // 10 * 10, i) for i in range(count)] + [(i, i + 10) for i in range(0, 100, 10)],
    }.get(shape, [(names[i], names[i + 1]) for i in range(count - 1)])
    written = []
    save = module.saved
    monkeypatch.setattr(module, "saved", lambda df, label, kept=None: written.append(label) or save(df, label, kept))
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    roots = {row["node"]: row["root"] for row in found.collect()}
    groups = {}
    for a, b in pairs:
        groups.setdefault(roots[a], set()).update((a, b))
        assert roots[a] == roots[b]
    assert len(groups) == (20 if shape == "combs" else 1)
    assert written.count("moves") <= 9 and written.count("jumps") <= 40
