"""Alignment against a plain one on whole texts, token by token."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallymill.llm.alignment import align, terminals
from tallymill.llm.queries import op12_cross_tokenizer_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "a  b \n\n c\t d  ",
    "x▁y z",
    "▁ a",
    "日本語 テキスト <|endoftext|> <s> </s>",
    "a b　c   d",
    "é ﬁ \x00 \x1c q\x1c r \r\n \u0085 z ᠎ s ​ t",
    "aaaa " * 50,
    "👩‍👩‍👧 emoji 𝔘",
    "don't we'll 's x's",
    "x" * 3000,
    "same",
    "same",
]


def plain(rows):
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` by comparing all tokens of a group."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def piece(i):
        name = pieces.id_to_piece(i)
        return bytes([int(re.fullmatch("<0x(..)>", name)[1], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = b" " + text.encode() if text else b""
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a, bytes_b = [bytes(byte_of[c] for c in tokenizer.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not b"".join(bytes_a) == whole == b"".join(bytes_b):
            a = b = bytes_a = bytes_b = []
        ends_a, ends_b = ([*itertools.accumulate(map(len, t))] for t in (bytes_a, bytes_b))
        groups, links, i, j = [], [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            for u, v in itertools.product(range(i, k), range(j, m)):
                if max(ends_a[u] - len(bytes_a[u]), ends_b[v] - len(bytes_b[v])) < min(ends_a[u], ends_b[v]):
                    links.append((a[u], b[v]))
            i, j = k, m
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (doc_id, len(a), len(b), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), ";".join(g))
        for doc_id, a, b, g, x in found
    ]


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "") for row in plain(rows)]
    assert sorted(map(tuple, op12_cross_tokenizer_alignment(spark, sf_dir).collect())) == sorted(expected)


@pytest.mark.parametrize("block_bytes", [1, 1 << 24])
def test_odd_texts_in_any_blocks(spark, block_bytes):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(None, "x y"), (3, "x y")]
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id bigint, text string, block int, n_a int").repartition(3)
    found = align(docs, A, B, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain(rows), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string").limit(0)
    assert align(docs, A, B).collect() == []


def test_pointers_reach_the_end_of_long_components():
    rng = np.random.default_rng(7)
    for size in (1, 2, 10, 1000):
        for _ in range(20):
            places = np.arange(1, 3 * size)
            ends = [np.append(np.sort(rng.choice(places, min(size, len(places)), replace=False)), 3 * size) for _ in "ab"]
            common = np.intersect1d(*ends)
            last = terminals(*ends)
            reached = np.concatenate([common[np.searchsorted(common, e)] for e in ends])
            assert np.array_equal(ends[1][last - len(ends[0])], reached)
    steps = np.arange(2, 20_002, 2)
    ends_a, ends_b = np.append(steps - 1, 20_001), np.append(steps, 20_001)
    assert set(terminals(ends_a, ends_b).tolist()) == {len(ends_a) + len(ends_b) - 1}
