import numpy as np
import pytest
import xxhash

from tallymill.llm import components, queries, simhash


def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < size else [words[i : i + size] for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(items, radius=3):
    """items: (id, fingerprint)"""
    prints = sorted({p for _, p in items})
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                group[root(a)] = root(b)
    least = {}
    for i, p in items:
        if i is not None:
            least[root(p)] = min(i, least.get(root(p), i))
    return sorted(((i, least.get(root(p))) for i, p in items), key=str)


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "one", "One two", "a b c", "A b  c\x0bd\xa0e É", "x " * 1000, "ß\x1cq w e r t y " * 40]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    words = [f"w{i * i % 977}" for i in range(140_000)]
    assert simhash.fingerprint(" ".join(words)) == plain_fingerprint(" ".join(words))


def clustered(rng, count):
    """Fingerprints far apart, chains of near ones, a dense ball, and many that share one half."""
    far = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2)
    chain = [int(far[0])]
    for _ in range(60):
        chain.append(chain[-1] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    ball = [int(far[1]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (count, 2))]
    half = [0xABCD | int(x) << 32 for x in rng.integers(0, 2**31, count)]
    return [int(x) for x in far] + chain + ball + half


def test_links_connect_what_pairs_connect(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 64)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    prints = clustered(np.random.default_rng(3), 400)
    signed = sorted({int(np.array(p, np.uint64).view(np.int64)) for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash.near_links(df)
    assert links.filter("bit_count(a ^ b) > 64").isEmpty()
    roots = {r.node: r.root for r in components.components(links).collect()}
    found = sorted(((p, roots.get(p, p)) for p in signed), key=str)
    plain = plain_components([(p, p & (2**64 - 1)) for p in signed])
    assert found == plain


def test_a_fingerprint_visits_every_shard_with_a_neighbour():
    rng = np.random.default_rng(5)
    points = np.array(sorted(set(clustered(rng, 500))), np.uint64)
    met = set()
    for half in simhash.HALVES:
        who, shard, home = simhash.visit(points, simhash.fit_tree(points[::3], half, 32))
        assert sorted(who[home]) == list(range(len(points)))
        for s in set(shard):
            inside, lives = who[shard == s], home[shard == s]
            for i in inside[lives]:
                met |= {(min(i, j), max(i, j)) for j in inside}
    near = np.argwhere(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)
    assert {(a, b) for a, b in near if a < b} <= met


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, fp int, root string")


LONG = " ".join(f"word{i}" for i in range(3000))
ROWS = [
    (5, None),
    (6, ""),
    (7, " \n"),
    (None, ""),
    (8, LONG),
    (9, LONG.upper()),
    (10, LONG + " more"),
    (10, LONG + " more"),
    (None, "all alone here now"),
    (11, "something else entirely this is"),
    (2, "tiny"),
]


def test_groups_of_a_small_table(spark):
    found = simhash.near_groups(frame(spark, ROWS)).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in ROWS]
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == plain_components(prints)


def test_empty_table(spark):
    assert simhash.near_groups(frame(spark, [])).collect() == []
    assert simhash.drop_near_copies(frame(spark, [])).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    kept = simhash.drop_near_copies(frame(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "fp", "root"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 5, 8, 11]


def test_query_agrees_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = queries.op6_simhash_near_dedup(spark, sf_dir).collect()
    prints = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    assert sorted((r.doc_id, r.fingerprint) for r in found) == sorted((i, f"{p:016x}") for i, p in prints)
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == plain_components(prints)
