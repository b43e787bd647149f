"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Each line that may speak of a licence is compared with short notices, the whole text and the comment at its top with full licence texts,
weighted by how rare their words are in the documents. A file without a licence of its own takes that of the nearest directory above it that holds a licence file: distinct directories are
joined with licensed ones by each of their ancestors' paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, saved, whole_text

LEAST_COSINE = 0.6
#: A whole text, or the comment at its top, is a licence text from this cosine on; a file that is one is a licence file.
TEXT_COSINE = 0.8
#: So is a file if lines that speak of its licence hold this share of its words, or one with a licence by its name.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"

# Names of licences and usual notices of them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "All rights reserved. No part may be reproduced without permission."],
}

for _name, _notices in TEMPLATES.items():
    if _name != "Proprietary":
        _notices.append(f"SPDX-License-Identifier: {_name}")

_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_TRIGGER = re.compile(r"licen[cs]|copyright|permission|public domain|all rights|redistribut|\bcc0?\b|\bmit\b", re.IGNORECASE)
# The comment that a text begins with.
_COMMENT = re.compile(
    r"/\*.*?\*/|<!--.*?-->|\"{3}.*?\"{3}|'{3}.*?'{3}|(?:[ \t]*(?:#|//|--|;|%)[^\n]*(?:\n|\Z)|[ \t]*\n)+", re.DOTALL
)


def licence_texts() -> dict[str, list[str]]:
    """Full texts by licence, from the files beside this module."""
    files = [f for f in resources.files("tallymill.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")]
    return {f.name.removesuffix(".txt"): [f.read_text(encoding="utf-8")] for f in sorted(files, key=lambda f: f.name)}


def leading_comment(text: str) -> str:
    found = _COMMENT.match(text.lstrip())
    return found.group() if found else ""


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def versions(name: str) -> frozenset[str]:
    """How notices write the version that a licence's name holds: 3.0 or 3."""
    return frozenset(x for v in re.findall(r"[0-9.]+", name) for x in (v, v.removesuffix(".0")))


#: Words that tell licences of one family apart; a line and a notice agree in them.
_KINDS = {"lesser": "l", "lgpl": "l", "affero": "a", "agpl": "a", "nc": "nc", "noncommercial": "nc", "sa": "sa", "sharealike": "sa"}
_KINDS |= {"nd": "nd", "noderivatives": "nd", "noderivs": "nd"}
#: The version may stand some words behind a notice that names none.
_VERSION = re.compile(r"(?:version|\bv\.?)\s*([0-9]+(?:\.[0-9]+)*)", re.IGNORECASE)
VERSION_WITHIN = 400


def kinds(found: list[str]) -> frozenset[str]:
    """``noncommercial`` and the like; hyphens part words, so that Share-Alike is two."""
    joined = "".join(found)
    spelt = {_KINDS[w] for w in found if w in _KINDS}
    return frozenset(spelt | {_KINDS[w] for w in ("noncommercial", "sharealike", "noderivatives", "noderivs") if w in joined})


def vocabulary(templates: dict[str, list[str]]) -> frozenset[str]:
    return frozenset(w for notices in templates.values() for notice in notices for w in words(notice))


def document_frequencies(docs: DataFrame, known: frozenset[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many of them hold each known word; over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, total = Counter(), 0
        for batch in batches:
            for x in batch["text"]:
                # Words of other letters can hold no known one, so cutting at ASCII marks and spaces finds candidates.
                found.update(known.intersection(_WORD.findall(x.lower())))
                total += 1
        yield pd.DataFrame([("", total), *found.items()], columns=["word", "n"])

    sums = docs.select(whole_text(text).alias("text")).mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in sums.collect()}  # one row per known word at most
    return counts.pop("", 0), counts


class Matcher:
    """Unit vectors of the notices over known words, and of full texts over theirs."""

    def __init__(
        self, templates: dict[str, list[str]], total: int, counts: dict[str, int], texts: dict[str, list[str]] | None = None
    ) -> None:
        self.texts = Matcher(texts, total, counts) if texts else None
        known = vocabulary(templates)
        self.weight = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in known}
        self.rare = math.log(1 + total) + 1
        self.names = frozenset(templates)
        self.notices = [
            (name, self.vector(found), versions(name).intersection(found), kinds(found))
            for name, notices in templates.items()
            for n in notices
            for found in [words(n)]
        ]

    def vector(self, found: list[str]) -> dict[str, float]:
        """Words that no notice has weigh as much as the rarest, so that other text on a line lowers its cosine."""
        vector = {w: (1 + math.log(n)) * self.weight.get(w, self.rare) for w, n in Counter(found).items()}
        norm = math.sqrt(sum(x * x for x in vector.values())) or 1.0
        return {w: x / norm for w, x in vector.items()}

    def best(self, line: str, behind: str = "", whole: bool = False) -> tuple[float, str]:
        """The most similar notice's cosine and licence. A version that a notice names has to stand in the line; where it names none, the
        one that the line, or the text ``behind`` it, names decides. In ``whole`` texts other licences may be spoken of."""
        found = words(line)
        own, seen, kind = self.vector(found), set(found), kinds(found)
        best = (0.0, "")
        for name, notice, version, notice_kind in self.notices:
            if version.isdisjoint(seen) and version or (not whole and kind != notice_kind):
                continue
            cosine = sum(x * own.get(w, 0.0) for w, x in notice.items())
            if (cosine, name) > best and (name := name if version or whole else self.dated(name, line + behind)):
                best = max(best, (cosine, name))
        return best

    def dated(self, name: str, text: str) -> str | None:
        """The licence of the family and version that the text names; None where no template has that one."""
        family, _, own = name.rpartition("-")
        if not family.endswith("GPL") or not (named := _VERSION.search(text)) or named[1] in versions(own):
            return name
        other = [n for n in self.names if n.startswith(f"{family}-") and named[1] in versions(n)]
        return other[0] if other else None

    def whole(self, text: str) -> tuple[float, str] | None:
        """The licence whose full text this is, with its cosine. The text of AGPL-3.0 is that of GPL-3.0 but for its title and a section."""
        cosine, name = self.texts.best(text, whole=True) if self.texts and _TRIGGER.search(text) else (0.0, "")
        if cosine < TEXT_COSINE:
            return None
        return cosine, "AGPL-3.0" if name == "GPL-3.0" and "affero" in words(text[:2000])[:20] else name

    def scan(self, text: str, least: float) -> tuple[str | None, float | None, float]:
        """The licence of the whole text, or of the comment at its top, else of the most similar line; its cosine, and the share of words that speak
        of that licence, which is 1 for a licence text."""
        found = []
        if _TRIGGER.search(text):
            if whole := self.whole(text):
                return whole[1], whole[0], 1.0
            comment = leading_comment(text)
            if in_comment := self.whole(comment):
                return in_comment[1], in_comment[0], min(1.0, len(words(comment)) / max(1, len(words(text))))
            past = 0
            for line in text.split("\n"):
                past += len(line) + 1
                # A notice may be wrapped: last comes the line with the one behind it.
                for part in (line, *re.split(r"(?<=[.!?])\s+", line), line + "\n" + text[past : past + VERSION_WITHIN].split("\n", 1)[0]):
                    if _TRIGGER.search(part) and (part is line or _TRIGGER.search(line)):
                        cosine, name = self.best(part, "\n" + text[past : past + VERSION_WITHIN])
                        if cosine >= least:
                            found.append((cosine, name, len(words(part))))
                            break
        if not found:
            return None, None, 0.0
        cosine, name, _ = max(found)
        return name, cosine, min(1.0, sum(n for _, other, n in found if other == name) / max(1, len(words(text))))


def ancestors(directory: Column) -> Column:
    """Paths of a directory and all above it, nearest last; the top is the empty path."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, 1, n))))
    )


def scan_licences(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    least: float = LEAST_COSINE,
    templates: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, path, licence, cosine, origin, licence_path``.

    ``origin`` is ``own`` where a line is similar enough to a notice, or the text or its leading comment to a full licence text, ``inherited`` where the nearest directory above, its own one first,
    holds a licence file (``licence_path``), else ``none`` with no licence. Of several licence files in a directory the one with
    the largest cosine counts, then the one with the smallest path. Paths are cut at ``/``; a null path is the top directory's.
    A null text is empty and has no licence of its own. Rows that repeat an id are reported each; an empty table gives an empty
    result. Other columns are not read.
    """
    templates = templates or TEMPLATES
    texts = licence_texts()
    total, counts = document_frequencies(docs, vocabulary(templates) | vocabulary(texts), text)
    matcher = Matcher(templates, total, counts, texts)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), whole_text(text).alias("text")
    )
    scanned = saved(
        by_row(rows, lambda text: [matcher.scan(text, least)], "licence string, cosine double, share double").withColumn(
            "directory", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
        ),
        "scanned",
    )
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    files = scanned.filter(F.col("licence").isNotNull() & ((F.col("share") >= FILE_SHARE) | name.rlike(FILE_NAME)))
    best = F.min(F.struct((-F.col("cosine")).alias("order"), "path", "licence"))
    licensed = saved(
        files.groupBy("directory").agg(best.alias("best")).select(
            F.col("directory").alias("above"), F.col("best.licence").alias("given"), F.col("best.path").alias("licence_path")
        ),
        "licensed",
    )
    steps = scanned.select("directory").distinct().select("directory", F.posexplode(ancestors(F.col("directory"))).alias("depth", "above"))
    nearest = saved(
        steps.join(licensed, "above")
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "given", "licence_path")).alias("nearest"))
        .select("directory", "nearest.given", "nearest.licence_path"),
        "nearest",
    )
    own = F.col("licence").isNotNull()
    return scanned.join(nearest, "directory", "left").select(
        "doc_id",
        "path",
        F.coalesce("licence", "given").alias("licence"),
        "cosine",
        F.when(own, "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("licence_path")).alias("licence_path"),
    )
