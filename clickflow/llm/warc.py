"""WARC archives: writing, and reading with segments put together.

Writing is a Spark text write whose line separator is the blank lines that
end a record, so the files come from Spark's own committer. Bodies are
framed with chunked transfer encoding; a record larger than ``segment_bytes``
is written as a first segment and continuation records. Reading splits at the
version line, groups the segments of an origin record, orders them by segment
number, checks the total length, and decodes the chunks. Chunk edges are laid
so that no body holds a version line, which keeps the split exact for any
payload.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.sqltext import let, ready_workers, save_shared
from clickflow.session import shared_dir

VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF * 2
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_HEAD = ("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
             + "Transfer-Encoding: chunked" + END)

SEGMENT_CHARS = 16_384  # body characters in one record; a longer body is segmented
CHUNK_CHARS = 4_096     # characters in one transfer chunk
MIN_REVISIT_BYTES = 0   # payloads of at least this size are written once


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a string's UTF-8 bytes, as archives have it."""
    h = F.sha1(payload.cast("binary"))
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0")
                        for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _runs(text: Column, size: int) -> Column:
    """``text`` cut into runs of ``size`` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def chunked(body: Column, size: int = CHUNK_CHARS) -> Column:
    """``body`` in chunked transfer framing. Pieces never span the middle of
    a version line, so the framed text has none."""
    cut = F.split(body, r"(?<=WARC)(?=/1\.)")
    pieces = F.flatten(F.transform(cut, lambda part: _runs(part, size)))
    framed = F.transform(pieces, lambda c: F.concat(
        F.lower(F.hex(F.octet_length(c))), F.lit(CRLF), c, F.lit(CRLF)))
    return F.concat(F.array_join(framed, ""), F.lit("0" + END))


def _field(name: str, value: Column) -> Column:
    """One header line; nothing for NULL. Line ends in a value become blanks."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, digest, n_bytes, first_id.

    ``first_id`` is the smallest page_id among equal payloads of at least
    ``min_bytes`` bytes where that is another page, else NULL. Pages that
    share the smallest id are all kept as responses; a NULL id never is the
    smallest unless all are NULL, and then none is a revisit. Digests are
    combined map-side, and only those of several rows are joined back.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumns({"digest": base32_sha1(F.col("payload")),
                       "n_bytes": F.octet_length("payload").cast("long")})
    same = (p.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
            .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) & F.col("first_id").isNotNull())
            .select("digest", "n_bytes", "first_id"))
    # written, so that both sides of the join are plain shuffles (or the
    # small one a broadcast) and a frequent payload can be split
    same = save_shared(same, "warc-payloads")
    j = p.join(same, ["digest", "n_bytes"], "left")
    first = F.when(F.col("first_id").eqNullSafe(F.col("page_id")), None).otherwise(F.col("first_id"))
    return j.withColumn("first_id", first)


def to_records(marked: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """WARC records as text (column ``value``), without the blank lines that
    end each; continuation records follow their origin record."""
    row = F.monotonically_increasing_id()
    revisit = F.col("first_id").isNotNull()
    m = marked.select("*", row.alias("row"))
    block = F.when(F.col("first_id").isNull(),
                   F.concat(F.lit(HTTP_HEAD), chunked(F.col("payload")))).otherwise(
        F.lit(HTTP_HEAD.split(CRLF + "Transfer")[0] + END))
    segs = let(block, lambda b: let(_runs(b, segment_chars), lambda parts: F.transform(
        parts, lambda part, i: F.struct(
            i.alias("no"), part.alias("part"), (i == F.size(parts) - 1).alias("last"),
            F.octet_length(b).cast("long").alias("total")))))
    s = m.select("page_id", "url", "digest", "n_bytes", "first_id", "row",
                 F.explode(segs).alias("s"))
    no, part, last = F.col("s")["no"], F.col("s")["part"], F.col("s")["last"]
    origin = F.concat(F.lit("<urn:record:"), F.col("row"), F.lit(">"))
    several = (no > 0) | ~last
    first = no == 0
    head = F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.when(~first, "continuation").when(revisit, "revisit")
               .otherwise("response")),
        _field("WARC-Record-ID", F.when(first, origin).otherwise(
            F.concat(F.lit("<urn:record:"), F.col("row"), F.lit(":"), no + 1, F.lit(">")))),
        _field("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        # a version marker in a URI is escaped, as the files are split at it
        _field("WARC-Target-URI", F.regexp_replace("url", r"WARC/1\.", "WARC%2F1.")),
        _field("Content-Type", F.when(first, "application/http; msgtype=response")),
        _field("WARC-Page-ID", F.when(first, F.col("page_id"))),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-Payload-Length", F.when(first, F.col("n_bytes"))),
        _field("WARC-Profile", F.when(first & revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Refers-To-Page-ID", F.when(first, F.col("first_id"))),
        _field("WARC-Segment-Number", F.when(several, no + 1)),
        _field("WARC-Segment-Origin-ID", F.when(~first, origin)),
        _field("WARC-Segment-Total-Length", F.when(several & last, F.col("s")["total"])),
        _field("Content-Length", F.octet_length(part)), F.lit(CRLF))
    return s.select(F.concat(head, part).alias("value"))


def write_warc(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT_BYTES,
               segment_chars: int = SEGMENT_CHARS) -> str:
    """Write one record (or its segments) per page to gzip'd archives below
    ``path`` (default: a new folder in the cluster's shared folder)."""
    path = path or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    records = to_records(mark_revisits(pages, min_bytes), segment_chars)
    records.write.option("lineSep", END).option("compression", "gzip").text(path)
    return path


def _header(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every WARC record below ``path``, one row each: type, record_id,
    page_id, uri, digest, payload_length, refers_to, segment, origin, total,
    length, block (binary), intact (the block has the declared length)."""
    raw = spark.read.option("lineSep", VERSION + CRLF).text(path).where(F.col("value") != "")
    head = F.substring_index("value", END, 1)
    r = raw.select(head.alias("head"), F.col("value").cast("binary").alias("raw"))
    length = _header("Content-Length").cast("long")
    start = F.octet_length("head") + F.lit(len(END) + 1)
    r = r.select("head", "raw", length.alias("length"), start.alias("start"))
    block = F.substring(F.col("raw"), F.col("start"), F.col("length").cast("int"))
    return r.select(
        _header("WARC-Type").alias("type"), _header("WARC-Record-ID").alias("record_id"),
        _header("WARC-Page-ID").cast("long").alias("page_id"),
        _header("WARC-Target-URI").alias("uri"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        _header("WARC-Payload-Length").cast("long").alias("payload_length"),
        _header("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        _header("WARC-Segment-Number").cast("int").alias("segment"),
        _header("WARC-Segment-Origin-ID").alias("origin"),
        _header("WARC-Segment-Total-Length").cast("long").alias("total"),
        "length", block.alias("block"),
        F.coalesce(F.octet_length(block) == F.col("length"), F.lit(False)).alias("intact"))


KEPT = ["record_id", "type", "page_id", "uri", "digest", "payload_length", "refers_to"]


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: the segments of an origin id joined in segment order.

    ``complete`` says that the segment numbers run without a gap or repeat,
    the last one declares the total, and the bytes add up to it. Records of
    one segment pass without a shuffle; a group holds one record, never more.
    Continuations whose origin is missing give an incomplete record.
    """
    whole = records.where(F.col("segment").isNull()).select(
        *KEPT, "block", F.col("intact").alias("complete"))
    seg = records.where(F.col("segment").isNotNull())
    key = F.coalesce("origin", "record_id")
    firsts = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in KEPT[1:]]
    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))
    g = seg.groupBy(key.alias("record_id")).agg(
        *firsts, parts.alias("parts"), F.max("total").alias("total"),
        F.min("intact").alias("intact"))
    block = F.unhex(F.array_join(F.transform("parts", lambda x: F.hex(x["block"])), ""))
    g = g.withColumn("block", block)
    n = F.size("parts")
    run = F.transform("parts", lambda x: x["segment"]) == F.sequence(F.lit(1), n)
    ok = F.col("intact") & run & (F.octet_length("block") == F.col("total"))
    return whole.unionByName(g.select(*KEPT, "block", F.coalesce(ok, F.lit(False))
                                      .alias("complete")))


def _dechunk(body: bytes) -> bytes | None:
    """The data of a chunked body; None if the framing is damaged."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            return None
        try:
            size = int(body[at:eol].split(b";")[0], 16)
        except ValueError:
            return None
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size:at + size + 2] != b"\r\n":
            return None
        out.append(body[at:at + size])
        at += size + 2


@F.pandas_udf(T.BinaryType())
def payload_of(block: pd.Series) -> pd.Series:
    """The decoded HTTP body of each block; NULL where it can't be decoded."""
    def one(b):
        if b is None:
            return None
        head, sep, body = bytes(b).partition(b"\r\n\r\n")
        if not sep:
            return None
        fields = {k.strip().lower(): v.strip().lower() for k, _, v in
                  (x.partition(b":") for x in head.split(b"\r\n")[1:])}
        return _dechunk(body) if fields.get(b"transfer-encoding") == b"chunked" else body
    return block.map(one)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per whole record: page_id, uri, type, payload (binary; NULL for
    a revisit or a damaged record), payload_bytes, payload_digest, refers_to,
    complete. Digest and length of a response come from its decoded bytes,
    those of a revisit from its header."""
    ready_workers(spark)
    whole = reassemble(read_records(spark, path))
    w = whole.withColumn("payload", F.when(F.col("type") != "revisit", payload_of("block")))
    is_revisit = F.col("type") == "revisit"
    good = is_revisit | (F.col("complete") & (base32_sha1(F.col("payload")) == F.col("digest")))
    return w.select(
        "page_id", "uri", "type", "payload",
        F.when(is_revisit, F.col("payload_length")).otherwise(
            F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(is_revisit, F.col("digest")).otherwise(base32_sha1(F.col("payload")))
        .alias("payload_digest"),
        "refers_to", F.coalesce(good, F.lit(False)).alias("complete"))
