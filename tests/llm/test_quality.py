import numpy as np
import pytest

from tallymill.llm import quality, queries

GOOD = "This is a plain sentence about the weather and the sea. Another one follows it, with other words in it. " * 3
ROWS = [(i, GOOD + f" Number {i} ends here.") for i in range(60)]
ROWS += [(100 + i, "WORD!! SHOUT!! %%% &&& " * 30 + str(i)) for i in range(8)]
ROWS += [(200, None), (201, ""), (202, " \n\t"), (None, GOOD), (203, GOOD * 300), (203, GOOD * 300), (204, "Short.")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1.0, False) for i, t in rows], "doc_id bigint, text string, score double, good boolean")


def test_estimation_finds_the_accuracy_of_labellers():
    """Votes drawn from known accuracies; labels are never seen."""
    rng = np.random.default_rng(1)
    bad_votes = {False: [0.6, 0.5, 0.7, 0.4, 0.5, 0.6, 0.5], True: [0.02, 0.01, 0.03, 0.02, 0.01, 0.02, 0.02]}
    counts, truth = {}, {}
    for _ in range(20_000):
        good = bool(rng.random() < 0.85)
        votes = [quality.BAD if rng.random() < p else quality.GOOD for p in bad_votes[good]]
        p = quality.pattern(votes)
        counts[p] = counts.get(p, 0) + 1
        truth.setdefault(p, []).append(good)
    found = quality.estimate(counts)
    assert found.prior == pytest.approx(0.85, abs=0.02)
    for k, good in enumerate((False, True)):
        assert found.chances[k][:, quality.BAD] == pytest.approx(bad_votes[good], abs=0.04)
    right = sum(sum(g == (found.good[p] >= 0.5) for g in known) for p, known in truth.items())
    assert right / 20_000 > 0.98


def test_patterns_hold_all_votes():
    votes = [2, 0, 1, 2, 2, 0, 1]
    assert quality.pattern_votes(quality.pattern(votes)) == votes


def test_judged_documents(spark):
    found = quality.judge(frame(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    bad = {r.doc_id for r in found if not r.good and r.doc_id != 204}  # one word says little
    assert bad == {*range(100, 108), 200, 201, 202}
    docs = frame(spark, ROWS)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL OR doc_id <> 204").count() == len(ROWS) - 12


def test_empty_tables(spark):
    assert quality.judge(frame(spark, [])).collect() == []
    assert quality.keep_good(frame(spark, [(1, "")])).collect() == []


def test_query_against_held_out_labels(spark):
    """Labels are used nowhere but here."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = {r.doc_id: r.good for r in queries.op2_quality_classifier(spark, sf_dir).collect()}
    bad = [found[i] for i, q in labels.items() if not q]
    good = [found[i] for i, q in labels.items() if q]
    assert len(found) == 1000 and sum(bad) <= 0.03 * len(bad) and sum(good) >= 0.99 * len(good)


SCRIPTS = {
    "zh": [
        "春天来了，公园里的花都开了。孩子们在草地上奔跑，老人们坐在长椅上聊天。微风吹过湖面，带来一阵清香。",
        "科学家最近发现了一种新的材料，它可以在很低的温度下传导电流。这项研究的结果已经发表在一份国际期刊上。",
    ],
    "th": ["กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย มีประชากรหลายล้านคน และเป็นศูนย์กลางของการค้าและวัฒนธรรม"],
    "ja": ["昨日は友達と一緒に図書館へ行きました。面白い本をたくさん見つけて、夕方まで読んでいました。"],
    "ru": ["Вчера мы ходили в старый город и долго гуляли по узким улицам. Потом мы сидели в кафе и пили чай."],
    "ar": ["ذهبنا أمس إلى المدينة القديمة وتجولنا في شوارعها الضيقة. ثم جلسنا في المقهى وشربنا الشاي."],
    "junk": ["的" * 200, "%%% 字$$$ ###的 &&&在*** " * 20, "ก" * 300, "!!!???。。。，，，" * 30, "Ж%%% Ы$$$ ***Ъ " * 20],
}


def test_no_script_is_thrown_out_wholesale(spark):
    """Good and bad texts of scripts that the corpus hardly holds, beside those that it does."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [(10**6, text, lang) for lang, texts in SCRIPTS.items() for text in texts + [" ".join(texts) * 4]]
    more = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    share = {row["lang"]: (row["documents"], row["kept"]) for row in quality.kept_share(docs.union(more), "lang").collect()}
    for lang, texts in SCRIPTS.items():
        assert share[lang] == (len(texts) + 1, 0.0 if lang == "junk" else 1.0), lang
    assert all(share[lang][1] > 0.8 for lang in ("en", "de", "fr", "es"))


def test_units_cover_the_text():
    for text in (GOOD, "", " \n", *[t for texts in SCRIPTS.values() for t in texts], "一" * 5 + "abc 二三，x"):
        assert "".join(quality.units(text)) == "".join(text.split())
    assert quality.units("plain words, only") == ["plain", "words,", "only"]
    assert quality.units("春天来，abc") == ["春天", "来，", "abc"]


def test_very_long_words_are_read_whole():
    assert quality.word_features("a" * 500) == quality.word_features("a" * 300)
    assert quality.word_features("a" * 500 + "%") != quality.word_features("a" * 500)
