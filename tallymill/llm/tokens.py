"""Exact token counts of every prefix of a text, by dynamic programming.

Byte-pair encoding works on pieces that a pattern cuts out of the text. Two facts make prefixes cheap. First, a single
space between two other characters always begins a piece, in the text and in each of its prefixes, so the text falls
into chunks that are counted on their own and kept by worker. Second, within a piece the encoding of a prefix ends with
one token, whose rest is the encoding of a shorter prefix: of all tokens that end there, it is the only one that
the pair rule lets follow that prefix's last token. So ``last[i]`` and ``count[i] = count[i - len(last[i])] + 1``
follow from left to right, without encoding any prefix again.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
import string
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymill.llm.common import by_row, whole_text

#: Chunks, and parts of chunks that are more than a word and marks, that a worker keeps; beyond that it starts anew.
KEPT_CHUNKS = 450_000
KEPT_WORDS = 150_000
KEPT_PAIRS = 600_000
#: Beginnings of pieces that a worker keeps the counts of, and how many bytes they have.
KEPT_BEGINNINGS = 150_000
_FROM_LONGEST = (10, 8, 6, 4)
_BEGINNINGS = frozenset(_FROM_LONGEST)

_GAP = re.compile(r"(?<=\S) (?=\S)")
#: An apostrophe may begin a piece that holds letters.
_MARKS = string.punctuation.replace("'", "")
#: Below this code point, letters and digits are the same in all versions of Unicode that libraries use.
SETTLED = "\u0250"

# What the pattern of byte-level vocabularies takes for white space, and its contractions.
_SPACES = frozenset("\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_CONTRACTIONS = frozenset(["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"])


def chunks(text: str, kept: Kept) -> list[bytes]:
    """``kept[c]`` for the first chunk and ``kept[" " + c]`` for each further one, in order.

    ``kept`` holds further chunks without their space in ``kept.after``; None there says that the chunk begins or ends
    with white space or is empty, so that the text must be cut with more care.
    """
    first, *rest = text.split(" ")
    if not first[-1:].isspace():
        found = [*map(kept.after.__getitem__, rest)]
        if None not in found:
            return [kept[first], *found]
    first, *rest = _GAP.split(text)
    return [kept[first], *[kept[" " + chunk] if (value := kept.after[chunk]) is None else value for chunk in rest]]


class Kept(dict):
    """What ``make`` gives for a chunk, as bytes, once for each chunk.

    A letter or digit and a mark behind it always belong to different pieces, and a line break between two other
    characters is a piece of its own; so words, marks and breaks are made one by one and put together.
    """

    class After(dict):
        def __init__(self, make, added: list[str]) -> None:
            self.make, self.added, self.parts = make, added, {}
            # Whether an added token may lie in a word with marks behind it.
            self.spelled = any(word.isalpha() or not word for word in (t.rstrip(_MARKS) for t in added))

        def part(self, text: str) -> bytes:
            value = self.parts.get(text)
            if value is None:
                value = self.make(text)
                if len(text) <= 64:
                    if len(self.parts) >= KEPT_WORDS:
                        self.parts.clear()
                    self.parts[text] = value
            return value

        def line(self, text: str) -> bytes:
            word = text.rstrip(_MARKS)
            if len(word) < len(text) and word[-1:].isalnum() and word[-1] < SETTLED:
                return self.part(word) + self.part(text[len(word) :])
            return self.part(text)

        def __missing__(self, chunk: str) -> bytes | None:
            word = chunk.rstrip(_MARKS)
            if word.isalpha() and word[-1] < SETTLED and not self.spelled:
                marks = chunk[len(word) :]
                return self.keep(chunk, self[word] + self.part(marks) if marks else self.make(" " + word))
            first, *rest = chunk.split("\n")
            if any(not x or x[0].isspace() or x[-1].isspace() for x in (first, *rest)):
                value = None
            elif any(t in chunk for t in self.added):
                value = self.make(" " + chunk)
            else:
                value = self.line(" " + first)
                for x in rest:
                    value += self.part("\n") + self.line(x)
            return self.keep(chunk, value)

        def keep(self, chunk: str, value: bytes | None) -> bytes | None:
            if len(chunk) <= 64:
                if len(self) >= KEPT_CHUNKS:
                    self.clear()
                self[chunk] = value
            return value

    def __init__(self, make, added: list[str]) -> None:
        self.make, self.after = make, Kept.After(make, added)

    def __missing__(self, chunk: str) -> bytes:
        value = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= KEPT_CHUNKS // 8:
                self.clear()
            self[chunk] = value
        return value


def load(path: str) -> tuple[Tokenizer, list[str]]:
    """A tokenizer file and the added tokens that texts may hold."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    spec = json.loads(tokenizer.to_str())
    pieces, added = spec["pre_tokenizer"], [t["content"] for t in spec["added_tokens"]]
    if spec["model"]["type"] != "BPE" or pieces["type"] != "ByteLevel" or pieces["add_prefix_space"] or spec["normalizer"]:
        raise ValueError("chunks need a byte-level BPE tokenizer without normaliser or prefix space")
    if any(any(c.isspace() for c in t) for t in added):
        raise ValueError("an added token holds white space")
    return tokenizer, added


class PrefixCounter:
    """Counts tokens as a byte-level BPE tokenizer file gives them, without begin, end or other added tokens."""

    def __init__(self, path: str) -> None:
        self.tokenizer, added = load(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        self.symbols = byte_symbols()
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in reversed(pairs)}
        made = {token: self.rank[halves] for token, halves in self.parts.items()}
        self.order = {s: -1 for s in self.symbols} | {token: made[token] for token in model["vocab"] if token in made}
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.follows: dict[int, bool] = {}
        self.begun: dict[str, tuple[list[int], list[int]]] = {}
        # Some tokens can only arise inside others: encoding their own bytes gives something else.
        self.tokens: list[str] = []
        self.number: dict[str, int] = {}
        for token in sorted(self.order, key=self.order.__getitem__):
            halves = self.parts.get(token)
            if not halves or all(h in self.number for h in halves) and self.may_follow(*halves, self.order[token]):
                self.number[token] = len(self.tokens)
                self.tokens.append(token)
        self.kept = Kept(self.deltas, added)

    def may_follow(self, a: str, b: str, limit: int = 1 << 60) -> bool:
        """Whether encoding the two tokens' bytes gives the two tokens, or does before the merge of rank ``limit``.

        It does if nothing ever merges across the border. Merges are undone, the latest first, and each pair that faced
        across the border must not have merged before the merge just undone. Of equal merges the left one is earlier.
        """
        while True:
            if self.rank.get((a, b), limit) < limit:
                return False
            made_a, made_b = self.order[a], self.order[b]
            if made_a > made_b:
                limit, a = made_a, self.parts[a][1]
            elif made_b >= 0:
                limit, b = made_b + 1, self.parts[b][0]
            else:
                return True

    def piece(self, symbols: str) -> list[int]:
        """Token counts of all prefixes of a piece, from the empty one on; a symbol stands for a byte.

        Counts of a prefix depend on it alone, so a piece goes on from the longest beginning that an earlier one had too.
        """
        begun, number, follows = self.begun, self.number.get, self.follows
        last, count, done = [0], [0], 0
        for size in _FROM_LONGEST:
            if size <= len(symbols) and (found := begun.get(symbols[:size])):
                last, count, done = [*found[0]], [*found[1]], size
                break
        for i in range(done + 1, len(symbols) + 1):
            for start in range(i - 1, -1, -1):
                token = number(symbols[start:i])
                if token is None:
                    continue
                if start:
                    pair = last[start] << 32 | token
                    known = follows.get(pair)
                    if known is None:
                        if len(follows) >= KEPT_PAIRS:
                            follows.clear()
                        known = follows[pair] = self.may_follow(self.tokens[last[start]], self.tokens[token])
                    if not known:
                        continue
                last.append(token)
                count.append(count[start] + 1)
                break
            else:
                raise ValueError(f"no token ends {symbols[:i]!r}")
            if i in _BEGINNINGS:
                if len(begun) >= KEPT_BEGINNINGS:
                    begun.clear()
                begun[symbols[:i]] = [*last], [*count]
        return count

    def pieces(self, text: str) -> list[tuple[str, int, int]]:
        return [(s, a, b) for s, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def deltas(self, chunk: str) -> bytes:
        """For each character, by how much the count of the prefix that it ends differs from the one before."""
        inner = chunk[1:] if chunk[:1] == " " else chunk
        if inner.isalpha() and max(inner) < SETTLED:
            table = self.piece(self.symbols[32] + inner if len(inner) < len(chunk) and inner.isascii() else self._spelled(chunk))
            return _steps(table if len(table) == len(chunk) + 1 else self._at_characters(table, chunk))
        elif "'" in chunk or len(inner.split()) != 1 or len(inner) != len(inner.strip()) or self.added and self.added.search(chunk):
            # The cut into pieces depends on what follows.
            return _changes(self._prefixes(chunk))
        else:
            pieces = self.pieces(chunk)
        counts, base = [], 0
        for symbols, start, stop in pieces:
            table = self.piece(symbols)
            if len(symbols) == stop - start:
                counts += [base + n for n in table[1:]] if base else table[1:]
            else:
                at = 0
                for c in chunk[start:stop]:
                    at += len(c.encode())
                    counts.append(base + table[at])
            base += table[-1]
        return _changes(counts)

    def _prefixes(self, chunk: str) -> list[int]:
        """Counts of all prefixes of any text, in time linear in its length.

        An added token counts once it is whole, and what follows it starts anew; until then its characters are ordinary ones.
        """
        counts, start, base = [], 0, 0
        for match in self.added.finditer(chunk) if self.added else ():
            plain = [base, *(base + n for n in self._plain(chunk[start : match.end() - 1]))]
            base = plain[match.start() - start] + 1
            counts += [*plain[1:], base]
            start = match.end()
        return counts + [base + n for n in self._plain(chunk[start:])]

    def _plain(self, text: str) -> list[int]:
        """Counts of all prefixes of a text without added tokens.

        All pieces of a prefix but the last are pieces of the text, with two exceptions. White space at the end of a prefix is one
        piece, whereas in the text the last character of a run of it goes with what follows. And a contraction that is cut
        falls into its apostrophe and a letter.
        """
        counts, base, at, pieces = [], 0, 0, iter(self.pieces(text))
        _, begin, end = piece = next(pieces, ("", 0, 0))
        while at < len(text):
            if text[at] in _SPACES:
                past = at + 1
                while past < len(text) and text[past] in _SPACES:
                    past += 1
                run = text[at:past]
                table = self._by_character(self._spelled(run), run)
                counts += [base + n for n in table[1:]]
                base += table[-2]
                if run[-1] != " ":
                    base += self.piece(self._spelled(run[-1]))[-1]
                at = past
                continue
            while end <= at:
                _, begin, end = piece = next(pieces)
            whole = text[begin:end]
            table = self._by_character(piece[0], whole)
            if whole in _CONTRACTIONS:
                table[1] = self.piece("'")[-1]
                if len(whole) > 2:
                    table[2] = table[1] + self.piece(whole[1])[-1]
            counts += [base + n for n in table[1 + at - begin :]]
            base += table[-1]
            at = end
        return counts

    def _spelled(self, text: str) -> str:
        return "".join(map(self.symbols.__getitem__, text.encode()))

    def _by_character(self, symbols: str, text: str) -> list[int]:
        """``piece`` at the ends of characters only."""
        table = self.piece(symbols)
        return table if len(symbols) == len(text) else self._at_characters(table, text)

    def _at_characters(self, table: list[int], text: str) -> list[int]:
        return [table[n] for n in itertools.accumulate((len(c.encode()) for c in text), initial=0)]

    def prefix_changes(self, text: str) -> np.ndarray:
        """``cumsum`` of this is the token count of every non-empty prefix, character by character."""
        return np.frombuffer(b"".join(chunks(text, self.kept)), np.int8)


def _changes(counts: list[int]) -> bytes:
    """Steps from each count to the next as signed bytes; a token has fewer than 129 bytes, so steps fit."""
    return _steps([0, *counts])


def _steps(table: list[int]) -> bytes:
    """``_changes`` of counts from that of the empty prefix on."""
    return array("b", map(operator.sub, table[1:], table)).tobytes()


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


@functools.cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def longest_prefix(changes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(changes, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(
    docs: DataFrame, path: str, budgets: tuple[int, ...] = (), doc_id: str = "doc_id", text: str = "text", keep: bool = True
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, prefix``, and ``cut_B`` for each budget B.

    ``prefix`` is the stored table: a signed byte for each character, whose running sum is the exact count of the
    prefix that ends there; ``keep=False`` leaves it out of the result. ``cut_B`` is the length, in characters, of the
    longest prefix of at most B tokens. A null text counts as empty, with 0 tokens. Rows are independent: ties, repeated and null ids
    are reported as they come; an empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole_text(text)).cast("bigint").alias("n_bytes"),
        whole_text(text).alias("text"),
    )

    def make(text: str) -> list[tuple]:
        table = counter(path).prefix_changes(text)
        row = [int(table.sum(dtype=np.int64))]
        if keep:
            row.append(table.tobytes())
        return [(*row, *(longest_prefix(table, budget) for budget in budgets))]

    schema = "n_tokens bigint" + ", prefix binary" * keep + "".join(f", cut_{b} bigint" for b in budgets)
    return by_row(rows, make, schema)


def tokens_before(changes: bytes, length: int) -> int:
    """The count of the prefix of ``length`` characters, from a stored table."""
    return int(np.frombuffer(changes, np.int8)[:length].sum(dtype=np.int64))
