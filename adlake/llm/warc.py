"""WARC archives: writing, and reading by boundary-chain verification (operator 7).

*Writing.*  Records are rows of a text table whose line end is the last byte
of a record's closing blank lines, so Spark writes plain archives, many files
in parallel.  A payload seen before (by digest) becomes a revisit record of
the one with the smallest id; it holds the HTTP head, not the payload.

*Reading.*  Archives are split at the version line by Spark's own text reader,
so a file is read by many tasks.  But the version line may also stand inside a
payload (never in a head: a url that ends like one is written with a space
behind it).  Every piece therefore is only a candidate: its task emits its length
and the length of the record it would begin, if its head parses.  For each
file, offsets are summed up and every candidate points to its successor, the
offset behind its record; pointer jumping from the file's start marks what is
reachable.  Only those are records; other pieces belong to the payload of the
record before.  A file's table has three numbers for each candidate, no
payload.

Records in one piece, nearly all, are digested where they are read.  The rest
are put together from their pieces.

Defined results: null html is an empty payload; null urls are empty, line ends
in urls are dropped; a row with a null id is a response without one and never
referred to; rows with equal ids and payloads are all responses; an empty
table gives an empty archive.  What stands behind a broken record, up to the
end of its file, is not returned.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import arrow, stage
from adlake.operators.joins import sized_broadcast

VERSION = "WARC/1.1\r\n"
HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four groups of five bytes, eight digits each."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), HEX_DIGITS, BASE32_DIGITS)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 20_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_rows: int = 500_000) -> None:
    """One record for each row, in files of at most ``records_per_file``."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        # A space behind a url that ends like a version line: readers take it off, and the line is none.
        F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "[\r\n]", ""), VERSION.strip().replace(".", "[.]") + r"\z", "$0 ").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    known = rows.where(F.octet_length("html") >= min_bytes).select("id", sha1_base32(F.col("html")).alias("digest")).where("id is not null")
    first = known.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    again = stage(known.join(first, "digest").where("id > first").select("id", "digest", "first").distinct(), "warc-revisits")
    # Revisits are joined without moving payloads while their table is small; beyond that both sides are dealt.
    rows = rows.withColumn("digest", sha1_base32(F.col("html")))
    rows = rows.join(sized_broadcast(again, max_rows=broadcast_rows), ["id", "digest"], "left")
    eol = F.lit("\r\n")
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, eol, eol)
    block = F.when(F.col("first").isNull(), F.concat(http, F.col("html"))).otherwise(http)
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    record = F.concat(
        F.lit(VERSION + "WARC-Type: "),
        F.when(F.col("first").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Date: " + date + "\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("first").isNull(), F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        eol, eol, block, F.lit("\r\n\r"),
    )
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*$", re.M)
_COLUMNS = "type string, page_id long, refers_to long, uri string, payload_bytes long, payload_digest string"


def _head(piece: bytes) -> tuple[int, dict[str, str]] | None:
    """(bytes up to the block, fields) if the piece begins with a record's head."""
    at = piece.find(b"\r\n\r\n")
    if at < 0:
        return None
    fields = {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(piece[:at].replace(b"\r\n", b"\n"))}
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    return at + 4, fields


def _id(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _record(fields: dict[str, str], block: bytes) -> tuple:
    """(type, page_id, refers_to, uri, payload bytes, payload digest, payload); of a
    revisit, the digest its head names and the length its HTTP head does."""
    at = block.find(b"\r\n\r\n")
    payload = block[at + 4 :] if at >= 0 else block
    kind = fields["warc-type"]
    if kind == "revisit":
        http = {k.lower(): v for k, v in _FIELD.findall(block[: max(at, 0)].replace(b"\r\n", b"\n"))}
        size, digest, payload = int(http.get(b"content-length", b"0")), fields.get("warc-payload-digest", "").removeprefix("sha1:"), None
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return kind, _id(fields.get("warc-record-id")), _id(fields.get("warc-refers-to")), fields.get("warc-target-uri"), size, digest, payload


def _candidates(with_payload: bool):
    """What each piece would be as a record, and whether it is all there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(13)]
            for file, block, value in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (file, block) != now:
                    now, place = (file, block), 0
                else:
                    place += 1
                piece = value.encode() if isinstance(value, str) else value
                head = _head(piece)
                length, record = -1, (None,) * 7
                if head is not None:
                    start, fields = head
                    size = int(fields["content-length"])
                    length = len(VERSION) + start + size + 4
                    if len(piece) >= start + size:
                        record = _record(fields, piece[start : start + size])
                whole = len(VERSION) + len(piece) == length
                for column, x in zip(out, (file, block, place, len(piece), length, whole, *record), strict=True):
                    column.append(x)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            cells = [pa.array(c, t) for c, t in zip(out, types, strict=True)][: 12 + with_payload]
            yield pa.RecordBatch.from_arrays(cells, names=[x.split()[0] for x in _schema(with_payload).split(", ")])

    return run


def _schema(with_payload: bool) -> str:
    return "file string, block long, place long, piece_bytes long, record_bytes long, whole boolean, " + _COLUMNS + (", payload binary" if with_payload else "")


def reachable(start: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which candidates the chain from the first one reaches, by pointer jumping.

    ``start``: ascending offsets, ``after``: offset behind each one's record
    (negative: no record).  Each round doubles how far every pointer jumps.
    """
    n = len(start)
    if not n:
        return np.zeros(0, bool)
    to = np.searchsorted(start, after)
    to[(to < n) & (start[np.minimum(to, n - 1)] != after)] = n
    to[after < 0] = n
    jump = np.append(to, n)
    seen = np.zeros(n + 1, bool)
    seen[0] = True
    for _ in range(max(1, n).bit_length()):
        seen[jump[seen]] = True
        jump = jump[jump]
    return seen[:n]


def _chain(rows: pd.DataFrame) -> pd.DataFrame:
    """The record of each piece of one file, by its offset, and its part number in it."""
    rows = rows.sort_values(["block", "place"], ignore_index=True)
    size = rows["piece_bytes"].to_numpy(np.int64)
    # The first piece stands before the first version line.
    start = np.concatenate([[0], size[0] + np.concatenate([[0], np.cumsum(size[1:-1] + len(VERSION))])]) if len(rows) > 1 else np.zeros(1, np.int64)
    length = rows["record_bytes"].to_numpy(np.int64)
    head = np.zeros(len(rows), bool)
    if len(rows) > 1 and size[0] == 0:
        head[1:] = reachable(start[1:], np.where(length[1:] >= 0, start[1:] + length[1:], -1))
    # A record that claims more than the file has is broken.
    head &= (length >= 0) & (start + length <= start[-1] + len(VERSION) + size[-1])
    owner = np.maximum.accumulate(np.where(head, np.arange(len(rows)), -1))
    rows, owner, start = rows[owner >= 0], owner[owner >= 0], start
    at = start[rows.index.to_numpy()] if len(rows) else start[:0]
    offset = start[owner]
    part = rows.index.to_numpy() - owner
    inside = at < offset + length[owner]
    return rows.assign(offset=offset, part=part)[inside][["file", "block", "place", "offset", "part"]]


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(file, offset, type, page_id, refers_to, uri, payload_bytes,
    payload_digest[, payload]) of each record of the archives under ``path``."""
    pieces = spark.read.option("lineSep", VERSION).text(path).select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary"))
    scanned = pieces.mapInArrow(_candidates(with_payload), _schema(with_payload))
    table = stage(scanned, "warc-candidates")
    chain = stage(table.select("file", "block", "place", "piece_bytes", "record_bytes").groupBy("file").applyInPandas(_chain, "file string, block long, place long, offset long, part long"), "warc-chain")
    names = [x.split()[0] for x in _COLUMNS.split(", ")] + ["payload"] * with_payload
    found = table.join(chain, ["file", "block", "place"])
    one = found.where("part = 0 and whole").select("file", "offset", *names)
    split = found.where("part = 0 and not whole").select("file", "offset")
    if split.isEmpty():
        return one

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for file, offset, parts in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                text = VERSION.encode().join(x["value"] for x in sorted(parts, key=lambda x: x["part"]))
                start, fields = _head(text)
                for column, x in zip(out, (file, offset, *_record(fields, text[start : start + int(fields["content-length"])])), strict=True):
                    column.append(x)
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            cells = [pa.array(c, t) for c, t in zip(out, types, strict=True)][: 8 + with_payload]
            yield pa.RecordBatch.from_arrays(cells, names=["file", "offset", *names])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            places = []
            for file, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now, place = ((file, block), 0) if (file, block) != now else (now, place + 1)
                places.append(place)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.int64()), batch.column(2)], names=["file", "block", "place", "value"])

    wanted = chain.join(split, ["file", "offset"])
    raw = pieces.mapInArrow(numbered, "file string, block long, place long, value binary").join(wanted, ["file", "block", "place"])
    grouped = raw.groupBy("file", "offset").agg(F.collect_list(F.struct("part", "value")).alias("parts"))
    more = grouped.mapInArrow(put_together, "file string, offset long, " + _COLUMNS + (", payload binary" if with_payload else ""))
    return one.unionByName(more)
