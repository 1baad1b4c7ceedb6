"""WARC archives: records of pages, revisit resolution by payload digest, and reading back.

``resolve`` shuffles record headers only (id, digest, length) and names, of equal payloads of at least ``MIN_BYTES``
bytes, the record with the largest id the response and every other one its revisit. ``write_archive`` writes one record
a page with fresh headers, revisits without their payload, each a gzip member of its own, so that a record can be read
from its offset. Files are written by Spark's text writer, so the archive may lie in any store that Spark reaches (their
names end as that writer's do): the line separator it puts after each record is an empty gzip member. They are dealt out
by bytes, so a file holds about one partition's advisory size, whatever the sizes of pages.
``read_archive`` parses the files again, one member at a time, and takes digests from the payload bytes.

A null payload is empty, a null URL too. Rows with a null id are records too, but no response others refer to. Of repeated rows with
one id each becomes a record of the same type, and its name gets a number; with equal payloads a repeated winner is the
response every time, and references name the page. Tables may be empty; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import cut

MIN_BYTES = 1000
_NAME = "urn:page:"
#: A gzip member of nothing.
_NOTHING = gzip.compress(b"", mtime=0)
_LEVEL = 4
_PIECE = 1 << 13


def with_digest(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"))


def resolve(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id``, ``payload_digest`` and ``refers_to`` of the records that revisit another one, from (page_id, payload_bytes, payload_digest).

    Winners come from partial maxima, so a digest shared by any part of the rows is one row before the join; the join's
    other side has one short row a page and may be split by key and size at will.
    """
    big = headers.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "payload_digest")
    winners = big.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("least < refers_to").drop("least")
    return big.join(winners, "payload_digest").filter("page_id <> refers_to").select("page_id", "payload_digest", "refers_to").distinct()


def decisions(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``refers_to`` of revisits and ``several`` (whether other records have the id) of the records (``page_id``, ``payload_digest``) that need either."""
    ids = headers.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.count("*").alias("n")).filter("n > 1")
    several = headers.join(ids, "page_id", "left_semi").select("page_id", "payload_digest", F.lit(True).alias("several")).distinct()
    return resolve(headers, min_bytes).join(several, ["page_id", "payload_digest"], "full")


_CRLF = "\r\n"


def _head(kind: str, number: Column, date: str, more: Column, length: Column) -> Column:
    """A record's head, from the columns ``page_id``, ``url`` and ``payload_digest``."""
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: {kind}{_CRLF}WARC-Record-ID: <{_NAME}"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        number,
        F.lit(f">{_CRLF}WARC-Date: {date}{_CRLF}WARC-Target-URI: "),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", ""),
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha1:"),
        _base32(F.col("payload_digest")),
        more,
        F.lit(f"{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        length.cast("string"),
        F.lit(_CRLF + _CRLF),
    ).cast("binary")


def records(pages: DataFrame, decided: DataFrame, date: str) -> DataFrame:
    """Each page's record as a gzip member, from ``with_digest`` and ``decisions`` rows.

    Every page is packed as a response before the shuffle, so that packed bytes go through it; revisits then get a record
    of their own in place of it, and records of shared or null ids their numbers.
    """
    response = _head("response", F.lit(""), date, F.lit(""), F.col("payload_bytes"))
    packed = pages.select("page_id", "payload_digest", F.coalesce("url", F.lit("")).alias("url"), response.alias("head"), F.col("payload").cast("binary").alias("block"))
    schema = T.StructType([*packed.schema[:3], T.StructField("member", T.BinaryType())])
    joined = packed.mapInArrow(_pack, schema).join(decided, ["page_id", "payload_digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    number = F.when(F.col("several") | F.col("page_id").isNull(), F.concat(F.lit(":"), F.monotonically_increasing_id().cast("string")))
    profile = F.concat(F.lit(f"{_CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}WARC-Refers-To: <{_NAME}"), F.col("refers_to").cast("string"), F.lit(">"))
    again = F.when(revisit, _head("revisit", F.coalesce(number, F.lit("")), date, profile, F.lit(0)))
    return joined.select(F.when(~revisit, F.col("member")).alias("member"), again.alias("again"), number.alias("number")).mapInArrow(_settle, "member binary")


def _member(record: bytes) -> bytes:
    return gzip.compress(record, _LEVEL, mtime=0)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_member(head.as_py() + block.as_py() + b"\r\n\r\n") for head, block in zip(batch.column(3), batch.column(4), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=[*batch.schema.names[:3], "member"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for member, again, number in zip(*batch.columns, strict=True):
            if again.is_valid:
                out.append(_member(again.as_py() + b"\r\n\r\n"))
            elif number.is_valid:
                out.append(_member(gzip.decompress(member.as_py()).replace(b">\r\nWARC-Date", number.as_py().encode() + b">\r\nWARC-Date", 1)))
            else:
                out.append(member.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])


def _base32(hexadecimal):
    """RFC 4648 base32 of a SHA-1 given in hexadecimal: four groups of five bytes, eight letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = [F.conv(F.substring(hexadecimal, 10 * g + 1, 10), 16, 10).cast("long") for g in range(4)]
    return F.concat(*[F.substring(letters, F.shiftright(g, 35 - 5 * k).bitwiseAND(31).cast("int") + 1, F.lit(1)) for g in groups for k in range(8)])


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES, date: str | None = None) -> None:
    """Gzip files of WARC records under ``path``, all of one ``WARC-Date`` (now, unless given)."""
    full = with_digest(pages, id_col, url_col, html_col)
    headers = cut(full.select("page_id", "payload_bytes", "payload_digest"))
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    members = records(full, decisions(headers, min_bytes), date).hint("rebalance")
    members.select(F.col("member").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", _NOTHING.decode("latin-1")).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, one gzip member at a time."""
    view, at = memoryview(data), 0
    while at < len(data):
        if data.startswith(_NOTHING, at):
            at += len(_NOTHING)
            continue
        # In small pieces, since what follows a member comes back as a copy.
        member, pieces = zlib.decompressobj(wbits=31), []
        while not member.eof:
            if at >= len(data):
                raise ValueError("a gzip member is cut short")
            piece = view[at : at + _PIECE]
            pieces.append(member.decompress(piece))
            at += len(piece)
        at -= len(member.unused_data)
        record = b"".join(pieces)
        if not record:
            continue
        stop = record.index(b"\r\n\r\n")
        lines = record[:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record: {lines[0][:80]}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        block = record[stop + 4 : -4]
        if len(block) != int(headers["Content-Length"]) or record[-4:] != b"\r\n\r\n":
            raise ValueError(f"{headers['WARC-Record-ID']}: length and header differ")
        yield headers, block


def _page(name: str | None) -> int | None:
    number = name[len(_NAME) + 1 : -1].partition(":")[0] if name else ""
    return int(number) if number else None


_READ = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("block_bytes", T.LongType()), T.StructField("payload", T.StringType())])


def read_archive(spark, path: str) -> DataFrame:
    """One row a record; the digest of a response is that of its bytes and must equal its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse(content.as_py()):
                    named = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind = headers["WARC-Type"]
                    if kind == "response" and hashlib.sha1(block).hexdigest() != named:
                        raise ValueError(f"{headers['WARC-Record-ID']}: payload and digest differ")
                    rows.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI", ""), kind, _page(headers.get("WARC-Refers-To")), named, len(block), block.decode() if kind == "response" else None))
                    if len(rows) == 1000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, _READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_READ.names)


def restore(archive: DataFrame) -> DataFrame:
    """Rows of ``read_archive`` without payloads, with ``payload_bytes`` of the full payload: a revisit's is its response's."""
    # Materialised, so that the files are parsed once.
    heads = cut(archive.select("page_id", "url", "record_type", "refers_to", "payload_digest", F.col("block_bytes").alias("payload_bytes")))
    revisits, responses = heads.filter("record_type = 'revisit'").drop("payload_bytes"), heads.filter("record_type <> 'revisit'")
    wanted = revisits.select(F.col("refers_to").alias("page_id")).distinct()
    originals = responses.join(wanted, "page_id", "left_semi").groupBy(F.col("page_id").alias("refers_to")).agg(F.max("payload_bytes").alias("payload_bytes"))
    return responses.unionByName(revisits.join(originals, "refers_to", "left"))
