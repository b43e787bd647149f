"""Web archives with a two-level capture index.

Each task writes its captures to a WARC file of its own, one gzip member per record, and reports where each record lies. The
captures, sorted by reversed-host URL key and page, are cut into compressed blocks of lines; every index file ends with a sparse
directory of its blocks, and the first keys of the files are a table of their own. A lookup searches the first
keys, then the directory, then the block, each by bisection, and reads only the ranges that it was led to.

Files are written and read through the file system that the folder's address names, and under names that no other attempt of
a task uses; only files that a finished task reported are ever read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import saved, whole_text
from tallymill.scratch import scratch_path

#: Payloads of fewer bytes are always stored.
REVISIT_FROM = 1000
#: A WARC file is closed when it is this large.
FILE_BYTES = 1_000_000_000
BLOCK_LINES = 256
#: Captures of an index file, and the most index files, whose first keys go to every task (about 100 bytes each).
FILE_CAPTURES, MAX_FILES = 8_192, 32_768
_OPEN_FILES = 16
_NO_PAGE = -(1 << 63) - 1
_TRAILER = "<QQ"


def url_key(url: str | None) -> str:
    """``http://www.Example.com:80/a?b#c`` as ``com,example,www)/a?b``; a text that is no URL is its own key."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        return text
    if not host:
        return text
    key = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme.lower()):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


# Records


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.split(":")[2]
    return int(number) if number else None


def _shown(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """A gzip member with a response, or with a revisit whose block holds the response's HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url or "", safe="%:/?#[]@!$&'()*+,;=~")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _shown(digest)),
    ]
    if is_revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers += [("WARC-Profile", profile), ("WARC-Refers-To", _record_id(refers_to, digest))]
    return _member(headers, http if is_revisit else http + payload)


class Capture(NamedTuple):
    page_id: int | None
    record_type: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    payload: bytes | None


def parse_record(member: bytes) -> Capture:
    """What a record says; the digest of a stored payload is taken from the payload, and must be the one recorded."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x[16:] for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")))
    recorded = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
    page_id = _page_of(fields["WARC-Record-ID"])
    if fields["WARC-Type"] == "revisit":
        return Capture(page_id, "revisit", length, recorded, _page_of(fields["WARC-Refers-To"]), None)
    if len(payload) != length or hashlib.sha1(payload).hexdigest() != recorded:
        raise ValueError(f"payload of page {page_id} is damaged")
    return Capture(page_id, "response", length, recorded, None, payload)


# Files


class _Files:
    """A few open files, for reading ranges."""

    def __init__(self) -> None:
        self.open: OrderedDict[str, pyarrow.NativeFile] = OrderedDict()

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path not in self.open:
            if len(self.open) >= _OPEN_FILES:
                self.open.popitem(last=False)[1].close()
            system, name = pyarrow.fs.FileSystem.from_uri(path)
            self.open[path] = system.open_input_file(name)
        self.open.move_to_end(path)
        file = self.open[path]
        file.seek(offset)
        return file.read(length)

    def end(self, path: str, length: int) -> bytes:
        self.read(path, 0, 0)
        return self.read(path, self.open[path].size() - length, length)

    def close(self) -> None:
        for file in self.open.values():
            file.close()


def _create(root: str, ending: str):
    path = f"{root}/{uuid.uuid4().hex}{ending}"
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return path, system.open_output_stream(name, compression=None)


def _number(value: str | None) -> int | None:
    return None if pd.isna(value) else int(value)


def _as_text(name: str) -> Column:
    """Numbers cross to pandas as text, since a null would turn them into floats."""
    return F.col(name).cast("string").alias(name)


# Writing


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages that repeat a payload of ``REVISIT_FROM`` bytes or more."""
    digests = saved(pages.select("page_id", "digest", "size").filter(F.col("size") >= REVISIT_FROM), "payloads")
    stored = saved(
        digests.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .filter("copies > 1 AND refers_to IS NOT NULL")
        .drop("copies"),
        "stored",
    )
    repeats = digests.join(stored, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return saved(repeats.select("page_id", "digest", "refers_to").distinct(), "revisits")


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes one record per page and returns ``url_key, page_id, file, offset, length``, written as well."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        whole_text("html").cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    repeats = revisits(rows).toDF("other_id", "other_digest", "refers_to")
    same = (F.col("digest") == F.col("other_digest")) & F.col("page_id").eqNullSafe(F.col("other_id"))
    marked = rows.join(repeats, same, "left").select(
        _as_text("page_id"), "url", "payload", "digest", _as_text("refers_to")
    )

    columns = marked.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, out, offset = None, None, 0
        try:
            for batch in batches:
                lines = []
                for page, url, payload, digest, refers in zip(*(batch[c] for c in columns), strict=True):
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        (path, out), offset = _create(root, ".warc.gz"), 0
                    page, refers = _number(page), _number(refers)
                    url = None if pd.isna(url) else url
                    member = make_record(page, url, bytes(payload), digest, refers, refers is not None)
                    out.write(member)
                    lines.append((url_key(url), page, path, offset, len(member)))
                    offset += len(member)
                made = pd.DataFrame(lines, columns=["url_key", "page_id", "file", "offset", "length"])
                made["page_id"] = made["page_id"].astype("Int64")
                yield made
        finally:
            if out is not None:
                out.close()

    return saved(
        marked.mapInPandas(write, "url_key string, page_id bigint, file string, offset bigint, length bigint"), "captures"
    )


def _file_count(rows: DataFrame) -> int:
    return max(1, min(MAX_FILES, -(-rows.count() // FILE_CAPTURES)))


def write_index(captures: DataFrame, root: str) -> DataFrame:
    """Index files over ``captures``; returns ``first_key, first_page, file``, the top level, written as well."""

    columns = captures.columns
    ordered = captures.repartitionByRange(_file_count(captures), "url_key", "page_id").sortWithinPartitions("url_key", "page_id")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, out, offset, directory, lines = None, None, 0, [], []

        def flush() -> int:
            block = zlib.compress(json.dumps(lines).encode(), 6)
            out.write(block)
            directory.append([*lines[0][:2], offset, len(block)])
            return len(block)

        for batch in batches:
            for key, page, *where in zip(*(batch[c] for c in columns), strict=True):
                if out is None:
                    path, out = _create(root, ".index")
                lines.append([key, _NO_PAGE if pd.isna(page) else int(page), *where])
                if len(lines) == BLOCK_LINES:
                    offset += flush()
                    lines.clear()
        if out is not None:
            if lines:
                offset += flush()
            listed = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(listed)
            out.write(struct.pack(_TRAILER, offset, len(listed)))
            out.close()
            yield pd.DataFrame({"first_key": [directory[0][0]], "first_page": [str(directory[0][1])], "file": [path]})

    ordered = ordered.withColumn("page_id", _as_text("page_id"))
    return saved(ordered.mapInPandas(write, "first_key string, first_page string, file string"), "index")


# Reading


class Index:
    """Finds captures by key and page; keeps the directory and the block that it used last."""

    def __init__(self, files: list[tuple[str, int, str]]) -> None:
        self.files = sorted(files)
        self.keys = [x[:2] for x in self.files]
        self.data = _Files()
        self.listed: tuple[str | None, list] = (None, [])
        self.block: tuple[tuple | None, list] = (None, [])

    def directory(self, path: str) -> list:
        if self.listed[0] != path:
            offset, length = struct.unpack(_TRAILER, self.data.end(path, struct.calcsize(_TRAILER)))
            self.listed = path, json.loads(zlib.decompress(self.data.read(path, offset, length)))
        return self.listed[1]

    def lines(self, path: str, offset: int, length: int) -> list:
        if self.block[0] != (path, offset):
            self.block = (path, offset), json.loads(zlib.decompress(self.data.read(path, offset, length)))
        return self.block[1]

    def find(self, key: str, page: int) -> Iterator[list]:
        """All lines of the key and page, which may begin at the end of one block or file and go on in the next."""
        wanted = (key, page)
        for file in range(max(0, bisect_left(self.keys, wanted) - 1), bisect_right(self.keys, wanted)):
            path = self.files[file][2]
            listed = self.directory(path)
            starts = [tuple(x[:2]) for x in listed]
            for block in range(max(0, bisect_left(starts, wanted) - 1), bisect_right(starts, wanted)):
                lines = self.lines(path, *listed[block][2:])
                at = bisect_left(lines, [*wanted])
                while at < len(lines) and tuple(lines[at][:2]) == wanted:
                    yield lines[at]
                    at += 1


def read_captures(requests: DataFrame, index: DataFrame, payloads: bool = False) -> DataFrame:
    """Every capture of each distinct ``url, page_id`` asked for, read from the archives through the index.

    ``payloads`` adds the stored text; a revisit has none.
    """
    files = [(r["first_key"], int(r["first_page"]), r["file"]) for r in index.collect()]  # MAX_FILES at most
    key = F.udf(url_key, "string")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Index(files)
        for batch in batches:
            rows = []
            for url, page in zip(batch["url_key"], batch["page_id"], strict=True):
                for _, _, path, offset, length in found.find(url, _NO_PAGE if pd.isna(page) else int(page)):
                    rows.append(parse_record(found.data.read(path, offset, length)))
            out = pd.DataFrame(rows, columns=list(Capture._fields))
            for name in ("page_id", "refers_to"):
                out[name] = out[name].astype("Int64")
            yield out if payloads else out.drop(columns="payload")
        found.data.close()

    asked = requests.select(key(F.col("url").cast("string")).alias("url_key"), F.col("page_id").cast("bigint").alias("page_id")).distinct()
    ordered = asked.repartitionByRange(_file_count(requests), "url_key", "page_id").sortWithinPartitions("url_key", "page_id")
    ordered = ordered.withColumn("page_id", _as_text("page_id"))
    schema = "page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
    return ordered.mapInPandas(read, schema + ", payload binary" * payloads)


def archive_round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes a record per page (``page_id, url, html``), indexes them, and reads all of them back by URL and page.

    Of records with equal payloads of ``REVISIT_FROM`` bytes or more, the one with the largest ``page_id`` is a response, the
    others revisit it; smaller ones are all responses. A null html is an empty payload, a null url an empty key. Rows
    with a null id revisit a known one, and are responses if the group has none. Rows that repeat id and payload are the
    same kind of record, each written and read. An empty table gives an empty result. Other columns are not read.
    """
    root = scratch_path(pages.sparkSession, "archives")
    captures = write_archives(pages, f"{root}/warc")
    index = write_index(captures, f"{root}/index")
    return read_captures(pages, index, payloads)
