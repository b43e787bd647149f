import numpy as np
import pytest

from tallymill.llm import queries, tiling


def plain_tiles(doc, item, least):
    """Greedy string tiling by comparing all places."""
    doc, item, used_doc, used_item, total = list(doc), list(item), set(), set(), 0
    while True:
        best = 0
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used_doc and j + k not in used_item:
                    k += 1
                if k > best:
                    best, place = k, (i, j)
        if best < least:
            return total
        used_doc |= set(range(place[0], place[0] + best))
        used_item |= set(range(place[1], place[1] + best))
        total += best


def test_tiles_cover_what_a_plain_search_covers():
    rng = np.random.default_rng(1)
    for _ in range(150):
        item = rng.integers(1, 9, rng.integers(5, 30))
        parts = np.array_split(item, 3)
        doc = np.concatenate([rng.integers(1, 9, 8), parts[2], rng.integers(1, 9, 3), parts[0], parts[1]])
        found = tiling.tiles(doc, item, 4)
        assert len({p for d, _, n in found for p in range(d, d + n)}) == sum(n for _, _, n in found)
        assert len({p for _, i, n in found for p in range(i, i + n)}) == sum(n for _, _, n in found)
        assert all((doc[d : d + n] == item[i : i + n]).all() for d, i, n in found)
        assert [n for _, _, n in found] == sorted((n for _, _, n in found), reverse=True)
        assert sum(n for _, _, n in found) == pytest.approx(plain_tiles(doc, item, 4), abs=8)


def test_run_hashes_tell_runs_apart():
    ids = np.random.default_rng(2).integers(0, 4, 300)
    for length in (1, 2, 5, 13):
        hashes = tiling.run_hashes(ids, length)
        runs = [tuple(ids[i : i + length]) for i in range(len(ids) - length + 1)]
        assert len(hashes) == len(runs)
        assert len({*zip(hashes.tolist(), runs, strict=True)}) == len({*runs}) == len({*hashes.tolist()})


ITEM = " ".join(f"w{i}" for i in range(40))
HALVES = ITEM.split()


def frames(spark, docs, items):
    left = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id bigint, text string, item_id int, mark string")
    return left, spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, doc_id int")


DOCS = [
    (1, "before " + ITEM.upper() + ", after"),
    (2, " ".join(HALVES[20:]) + " between " + " ".join(HALVES[:20])),
    (3, " ".join(HALVES[:20])),
    (4, "nothing of the kind in here at all"),
    (5, None),
    (6, ""),
    (None, ITEM),
    (7, "x " * 30_000 + ITEM),
    (8, ITEM),
    (8, ITEM),
    (9, "one two three"),
]
ITEMS = [(10, ITEM), (11, ITEM), (12, None), (13, "one two three"), (14, "")]


@pytest.mark.parametrize("block", [8_000_000, 100])
def test_contaminated_documents(spark, monkeypatch, block):
    monkeypatch.setattr(tiling, "BLOCK_BYTES", block)
    docs, items = frames(spark, DOCS, ITEMS)
    found = tiling.contaminated(docs, items).collect()
    expected = [(i, item) for i in (1, 2, 7, 8, 8, None) for item in (10, 11)]
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted(expected, key=str)
    assert {(r.doc_id, r.tiles, r.tiled_words, r.coverage) for r in found if r.doc_id in (1, 2)} == {(1, 1, 40, 1.0), (2, 2, 40, 1.0)}
    left = tiling.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 9]


def test_empty_tables(spark):
    for docs, items in ((DOCS, []), ([], ITEMS), ([], [])):
        left, right = frames(spark, docs, items)
        assert tiling.contaminated(left, right).collect() == []
        assert tiling.drop_contaminated(left, right).count() == len(docs)


def test_query_agrees_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = {r.item_id: tiling.words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    numbers = {}
    expected = set()
    for d in docs:
        own = tiling.words(d.text)
        grams = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        doc = [numbers.setdefault(w, len(numbers)) for w in own]
        for key, item in items.items():
            shared = {p for i in range(len(item) - 4) if tuple(item[i : i + 5]) in grams for p in range(i, i + 5)}
            if len(shared) >= 0.8 * len(item) > 0:
                inside = [i for i in range(len(own)) if own[i] in item]
                part = doc[max(0, inside[0] - 5) : inside[-1] + 5]
                if plain_tiles(part, [numbers.setdefault(w, len(numbers)) for w in item], 5) >= 0.8 * len(item):
                    expected.add((d.doc_id, key))
    found = queries.op5_benchmark_decontamination(spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)


def test_short_items_and_scripts_without_spaces(spark):
    chinese, thai = "床前明月光，疑是地上霜。举头望明月，低头思故乡。", "กรุงเทพมหานครเป็นเมืองหลวง"
    items = [(1, "Quite short item"), (2, chinese), (3, thai), (4, "月光"), (5, "..."), (6, None), (7, ITEM)]
    docs = [
        (1, "a quite, short item here"),
        (2, "quite a short item"),
        (3, "前言" + chinese + "后记"),
        (4, "คำ" + thai + "คำ"),
        (5, "明月 no"),
        (6, ITEM + " x"),
        (7, "quite short"),
    ]
    found = {(r.doc_id, r.item_id): r.coverage for r in tiling.contaminated(*frames(spark, docs, items), short=True).collect()}
    assert found == {(1, 1): 1.0, (3, 2): 1.0, (3, 4): 1.0, (4, 3): 1.0, (6, 7): 1.0}
    assert sorted(r.doc_id for r in tiling.drop_contaminated(*frames(spark, docs, items), short=True).collect()) == [2, 5, 7]
