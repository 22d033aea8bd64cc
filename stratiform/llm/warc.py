"""WARC archives: writing with revisit records, and a salvage reader.

Writing. Every row becomes one record, compressed as a gzip member of its own;
the blank lines that end a record are a second, constant member, which Spark's
text writer puts after each row as its line separator. So archives are written
by Spark on any file system it knows, about ``ARCHIVE_BYTES`` of payload each.
Of the rows with equal payloads of at least ``least`` bytes the ones with the
largest key are responses, the others revisits of them. The largest key of each
repeated payload comes from one aggregate by digest. Payloads on at least one
row of ``HOT_SHARE`` are at most that many, so they are broadcast; the rest is
joined by digest, in the shuffle that deals rows to archives.

Reading. An archive (plain, or gzip members of any number of records) is read
from its start. Every member must inflate with its checksum, every record must
have a version line, a length that ends at its blank lines and, where they are
named, fitting block and payload digests. After a failed check the reader looks
for the next gzip magic or version line from which a whole valid record can be
read, goes on there, and logs the bytes between as a quarantined gap with the
reason. Records at the head of a broken member are kept if they are whole.
Inside a member, gaps are counted in its inflated bytes.

Defined results: a null payload is empty; a null key is below all others; rows
equal in key and payload are the same capture, under one record id and of one
type; control characters and blanks in a URL are percent-encoded, a null URL
has no header; very long payloads are one record, held whole by one task; an
archive longer than ``most`` bytes raises an error, since one task reads it; an
empty table gives no archive and no rows; other columns are ignored. A whole
record quoted inside the payload of a broken one counts as recovered.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import arrow_map, bound_batches, stored, utf8_bytes

#: Payloads of fewer bytes are always stored.
LEAST = 1000
ARCHIVE_BYTES = 16 << 20
MOST_BYTES = 512 << 20
#: A payload on one row of so many is told to all tasks.
HOT_SHARE = 1000
END = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n"
#: Captures have no time in the tables; records need one.
_DATE = "1970-01-01T00:00:00Z"


def member(raw: bytes) -> bytes:
    """One gzip member, the same for the same bytes."""
    return gzip.compress(raw, compresslevel=6, mtime=0)


SEPARATOR = member(END)


def digest_field(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(key, hex_digest: str) -> str:
    name = "~" if key is None else quote(str(key), safe="").replace("~", "%7E")
    return f"<urn:x-page:{name}:{hex_digest}>"


def key_of(record: str | None) -> str | None:
    """The key, as text, inside a record id of this writer."""
    m = re.fullmatch(r"<urn:x-page:([^:>]*):[0-9a-f]{40}(?::revisit)?>", record or "")
    return None if m is None or m[1] == "~" else unquote(m[1])


def record(key, url: str | None, payload: bytes, hex_digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """A response or revisit record, without the blank lines that end it."""
    http = _HTTP.format(n=len(payload)).encode()
    block = http if revisit else http + payload
    own = record_id(key, hex_digest)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {own[:-1] + ':revisit>' if revisit else own}", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub("[\x00-\x20\x7f-\xa0\u2028\u2029]", lambda m: quote(m[0]), url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, hex_digest)}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(hex_digest)).decode()}",
             f"WARC-Block-Digest: {digest_field(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block


# ---------------------------------------------------------------- reading

@dataclass
class Found:
    """A record or a gap of an archive; places are those of its file or, inside a
    member, of the member's inflated bytes."""
    start: int
    stop: int
    member: int | None = None          # place of the member in the file
    reason: str | None = None          # of a gap
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    payload_bytes: int = 0
    payload_digest: str = ""


class Damaged(Exception):
    pass


_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_BLANK = re.compile(rb"[\r\n\x00]*")
_MAGIC = b"\x1f\x8b\x08"


def _fields(head: bytes) -> dict[str, str]:
    out, last = {}, None
    for line in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _check(named: str | None, raw: bytes, what: str) -> None:
    """A digest field against the bytes; algorithms other than SHA-1 are not checked."""
    if named is None or not named.lower().startswith("sha1:"):
        return
    value, own = named[5:].strip(), hashlib.sha1(raw).digest()
    if value.lower() != own.hex() and value.upper().rstrip("=") != base64.b32encode(own).decode():
        raise Damaged(f"{what} digest differs")


def read_record(data: bytes, at: int) -> Found:
    """The record that begins at a place; raises ``Damaged``."""
    if not _VERSION.match(data, at):
        raise Damaged("no version line")
    head = _HEAD_END.search(data, at)
    if head is None:
        raise Damaged("headers without an end")
    fields = _fields(data[at:head.start()])
    size = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size):
        raise Damaged("no content length")
    begin, stop = head.end(), head.end() + int(size)
    if stop > len(data):
        raise Damaged("record beyond the end")
    if data[stop:stop + 4] != END and data[stop:stop + 2] != b"\n\n" and data[stop:] not in (b"", b"\r\n", b"\n"):
        raise Damaged("length does not end at blank lines")
    block = data[begin:stop]
    _check(fields.get("warc-block-digest"), block, "block")
    payload, length, digest = block, len(block), None
    if fields.get("content-type", "").lower().startswith("application/http"):
        http = _HEAD_END.search(block)
        if http is None:
            raise Damaged("no end of the HTTP headers")
        payload, length = block[http.end():], len(block) - http.end()
        if fields.get("warc-type") == "revisit":
            told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", block[:http.end()])
            length = int(told[1]) if told else length
    named = fields.get("warc-payload-digest")
    if fields.get("warc-type") == "revisit":        # of the payload it stands for
        value = (named or "").partition(":")[2].strip()
        try:
            digest = value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
        except ValueError:
            raise Damaged("revisit without a payload digest") from None
    else:
        _check(named, payload, "payload")
        digest = hashlib.sha1(payload).hexdigest()
    return Found(at, stop, None, None, fields, payload, length, digest)


def read_member(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int, str | None]:
    """Inflated bytes of the gzip member at a place, its end, and what is wrong with it.
    Of a broken member the bytes inflated before the fault are given."""
    work, out, pos = zlib.decompressobj(31), [], at
    try:
        while not work.eof:
            if pos >= len(data):
                return b"".join(out), pos, "member beyond the end"
            part = data[pos:pos + step]
            pos += len(part)
            out.append(work.decompress(part))
    except zlib.error as fault:
        return _before_fault(data[at:pos]), pos, f"member: {str(fault).rpartition(': ')[2]}"
    return b"".join(out), pos - len(work.unused_data), None


def _before_fault(raw: bytes, step: int = 256) -> bytes:
    """What a broken member inflates to before its fault, to within ``step`` bytes."""
    work, out = zlib.decompressobj(31), []
    try:
        while raw:
            out.append(work.decompress(raw, step))
            raw = work.unconsumed_tail
    except zlib.error:
        pass
    return b"".join(out)


def _plain(data: bytes, at: int = 0, stop_at_member: bool = False) -> Iterator[Found]:
    """Records and gaps of uncompressed bytes, in order. With ``stop_at_member`` the
    walk ends before a place where a gzip member begins."""
    n = len(data)
    while (at := _BLANK.match(data, at).end()) < n:
        if stop_at_member and data.startswith(_MAGIC, at):
            return
        try:
            found = read_record(data, at)
        except Damaged as fault:
            yield Found(at, (after := _next(data, at, stop_at_member)), None, str(fault))
            at = after
            continue
        yield found
        at = found.stop


def _next(data: bytes, at: int, members: bool) -> int:
    """The first place after ``at`` where a valid record or member begins, or the end. A version
    line need not stand at the start of a line: what was before it may be cut off."""
    line = _VERSION.search(data, at + 1)
    magic = data.find(_MAGIC, at + 1) if members else -1
    while line is not None or magic >= 0:
        if line is not None and (magic < 0 or line.start() < magic):
            try:
                read_record(data, line.start())
                return line.start()
            except Damaged:
                line = _VERSION.search(data, line.start() + 1)
        else:
            inside, _, fault = read_member(data, magic)
            if fault is None or any(f.reason is None for f in _plain(inside)):
                return magic
            magic = data.find(_MAGIC, magic + 1)
    return len(data)


def read_archive(data: bytes) -> Iterator[Found]:
    """Records and quarantined gaps of an archive, in order."""
    at, n = 0, len(data)
    while (at := _BLANK.match(data, at).end()) < n:
        if not data.startswith(_MAGIC, at):
            for found in _plain(data, at, True):
                yield found
                at = found.stop
            continue
        inside, stop, fault = read_member(data, at)
        if fault is None:
            for found in _plain(inside):
                found.member = at
                yield found
            at = stop
            continue
        for found in _plain(inside):
            if found.reason is None:
                found.member = at
                yield found
        after = _next(data, at, True)
        yield Found(at, after, None, fault)
        at = after


# ---------------------------------------------------------------- on Spark

def _leaders(rows: DataFrame, least: int) -> DataFrame:
    """``digest, bytes, n, leader``: payloads on several rows, and their largest key."""
    return stored(rows.where(F.col("bytes") >= least).groupBy("digest", "bytes")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("leader")).where("n > 1"), "warc-leaders")


def write_archives(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url",
                   html: str = "html", least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write a record for every row to gzip archives under ``path`` (a new shared folder
    by default) and return it."""
    spark = pages.sparkSession
    bound_batches(spark)
    path = path or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("html"),
                        F.sha1(payload.cast("binary")).alias("digest"), utf8_bytes(payload).alias("bytes"))
    leaders = _leaders(rows.select("key", "digest", "bytes"), least)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first()
    # A digest on one row of HOT_SHARE: at most HOT_SHARE of them, whatever the table.
    hot = leaders.where(F.col("n") * HOT_SHARE >= total["n"])
    cold = leaders.where(F.col("n") * HOT_SHARE < total["n"])
    rows = rows.withColumn("row", F.monotonically_increasing_id()).join(
        F.broadcast(hot.select(F.col("digest").alias("hot_digest"), F.col("bytes").alias("hot_bytes"), F.lit(True).alias("is_hot"),
                               F.col("leader").alias("hot_leader"))),
        (F.col("digest") == F.col("hot_digest")) & (F.col("bytes") == F.col("hot_bytes")), "left")
    # Rows with nothing to look up are dealt by their number, so no digest gathers them.
    asks = F.col("is_hot").isNull() & (F.col("bytes") >= least)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if (total["n"] or 0) > 1 else 1,
            -(-int(total["b"] or 0) // archive_bytes))
    rows = rows.withColumn("ask", F.when(asks, F.col("digest")).otherwise(F.col("row").cast("string"))).repartition(n, "ask")
    cold = cold.select(F.col("digest").alias("ask"), F.col("bytes").alias("cold_bytes"), F.lit(True).alias("is_cold"),
                       F.col("leader").alias("cold_leader"))
    rows = rows.join(cold, "ask", "left")
    leader = F.when(F.col("is_hot"), F.col("hot_leader")).otherwise(F.col("cold_leader"))
    again = (F.col("is_hot") | (F.col("is_cold") & (F.col("bytes") == F.col("cold_bytes")))) & ~F.col("key").eqNullSafe(leader)
    ready = rows.select("key", "url", F.col("html").cast("binary").alias("html"), "digest", leader.alias("leader"),
                        F.coalesce(again, F.lit(False)).alias("again"))

    def members(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(c).to_pylist() for c in ("key", "url", "html", "digest", "leader", "again")]
        return pa.record_batch([pa.array([member(record(k, u, h, d, to, r)) for k, u, h, d, to, r in zip(*columns)],
                                         pa.binary())], names=["value"])
    (arrow_map(ready, members, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path))
    return path


SCAN = ("archive string, member bigint, start bigint, stop bigint, reason string, record_id string, record_type string, "
        "refers_to string, target_uri string, payload_bytes bigint, payload_digest string")


def scan_archives(spark: SparkSession, path: str, most: int = MOST_BYTES, payloads: bool = False) -> DataFrame:
    """A row for every record (``reason`` null) and every quarantined gap of the
    archives under a path, with the payloads of responses if asked for."""
    bound_batches(spark)
    files = spark.read.format("binaryFile").load(path)
    long = files.where(F.col("length") > most).select("path", "length").limit(3).collect()
    if long:
        raise ValueError(f"archives of more than {most} bytes: {[(r['path'], r['length']) for r in long]}")
    names = [x.split()[0] for x in SCAN.split(", ")]

    def rows(archive: str, data: bytes):
        for f in read_archive(data):
            ok = f.reason is None
            row = (archive, f.member, f.start, f.stop, f.reason, f.headers.get("warc-record-id"), f.headers.get("warc-type"),
                   f.headers.get("warc-refers-to"), f.headers.get("warc-target-uri"),
                   f.payload_bytes if ok else None, f.payload_digest if ok else None)
            yield (*row, f.payload if ok and f.headers.get("warc-type") != "revisit" else None) if payloads else row
    arrow = pa.schema([(x.split()[0], pa.int64() if x.endswith("bigint") else pa.string()) for x in SCAN.split(", ")])
    if payloads:
        arrow, names = arrow.append(pa.field("payload", pa.binary())), [*names, "payload"]

    def run(batches):
        for batch in batches:
            for archive, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                out, held = [], 0
                for row in rows(archive, data.as_py()):
                    out.append(row)
                    held += len(row[-1] or b"") if payloads else 100
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)
    return files.select("path", "content").mapInArrow(run, SCAN + (", payload binary" if payloads else ""))


def records(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("reason").isNull()).drop("reason")


def gaps(scan: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return scan.where(F.col("reason").isNotNull()).select("archive", "member", "start", "stop", "reason")


def archive_digest(pages: DataFrame) -> DataFrame:
    """The contract's row for each page: all pages written, then read back."""
    kind = pages.schema["page_id"].dataType.simpleString()
    got = records(scan_archives(pages.sparkSession, write_archives(pages)))
    key = F.udf(key_of, "string") if kind == "string" else lambda c: F.regexp_extract(c, "^<urn:x-page:([^:>]*):", 1)
    read = lambda c: F.when(key(F.col(c)) != "~", key(F.col(c))).cast(kind)
    return got.select(read("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.when(F.col("record_type") == "revisit", read("refers_to")).alias("refers_to"))


#: The same rows without archives.
ORACLE = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(OCTET_LENGTH(ENCODE(html)) AS BIGINT) AS payload_bytes, SHA1(html) AS payload_digest,
             MAX(page_id) OVER (PARTITION BY html) AS leader FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM leader THEN leader END AS refers_to
FROM d
"""
