"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

Writing goes through Spark's text sink, so the archives reach any store Spark can
write to: every row is the bytes of one gzip member (one record) and the row
separator is an empty gzip member, which readers skip. Reading takes whole
archive files (``binaryFile``); ``written archives`` stay near one input partition in size.

The salvage reader checks each record (gzip checksum, version line, length, block
digest). A response holds the page itself as its block, without an HTTP head, as the pages
have none; its type is ``text/html``. When a check fails it searches for the next place where a valid record
begins, a gzip member or a plain version line, goes on there, and reports the
bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"  # the pages carry no time of capture; a fixed one keeps archives reproducible
MIN_REVISIT_BYTES = 1000
HEADER_LIMIT = 1 << 20  # bytes in which a record's header has to end
FIRST_PIECE, LAST_PIECE = 4 << 10, 256 << 10  # compressed bytes that a decompressor gets at a time
MEMBER = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
RECORD_ID = "urn:page:"
RECORDS = ("file string, offset long, length long, kind string, reason string, record_type string, record_id string, "
           "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary")


def _base32(digest_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(record_id: str, uri: str | None, payload: bytes, digest_hex: str, refers_to: str | None = None,
                level: int = 1) -> bytes:
    """One gzip member that holds a response, or a revisit if ``refers_to`` is given."""
    block = b"" if refers_to is not None else payload
    fields = [("WARC-Type", "revisit" if refers_to is not None else "response"),
              ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", uri or "")), ("Content-Type", "text/html; charset=utf-8"),
              ("WARC-Payload-Digest", _base32(digest_hex)),
              ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
              ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return gzip.compress(_record(fields, block), compresslevel=level, mtime=0)


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of equal payloads of at least
    ``min_bytes`` the largest page_id is the response and the others refer to it.

    Null html is an empty payload. Rows that repeat the largest page_id are all
    responses. A null page_id never wins against another id; if all are null, all
    are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    winners = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
               .agg(F.max("page_id").alias("winner"), F.count("*").alias("n")).where("n > 1")
               .select(F.upper("digest").alias("won"), "winner"))  # a key of its own: AQE may split the join
    joined = rows.join(winners, F.upper("digest") == F.col("won"), "left")
    refers = F.when(F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _members(batches):
    """One row (gzip member) per page, after a warcinfo record for the archive."""
    info = None
    for batch in batches:
        if info is None and batch.num_rows:
            info = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'archive:{TaskContext.get().partitionId()}')}"
            block = b"software: blendwise\r\nformat: WARC File Format 1.1\r\n"
            member = gzip.compress(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{info}>"), ("WARC-Date", DATE),
                                            ("Content-Type", "application/warc-fields")], block), mtime=0)
            yield pa.record_batch([pa.array([member], pa.binary())], names=["member"])
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256).to_pylist()
            out = [page_record(f"{RECORD_ID}{'' if r['page_id'] is None else r['page_id']}", r["url"], r["payload"], r["digest"],
                               None if r["refers_to"] is None else f"{RECORD_ID}{r['refers_to']}") for r in rows]
            yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one gzip WARC record per row of ``pages`` (page_id, url, html) under ``path``.

    Each Spark partition becomes one archive. An empty table writes no record.
    Columns other than these three are not read.
    """
    members = with_roles(pages, min_bytes).mapInArrow(_members, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path))


_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def _parsed(data: bytes, at: int = 0) -> tuple[dict, bytes, int] | None:
    """Header fields, block and size of the record at ``at``; None if not valid."""
    if not _VERSION_LINE.match(data, at):
        return None
    end = data.find(b"\r\n\r\n", at, at + HEADER_LIMIT)
    if end < 0:
        return None
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, sep, value = line.partition(b":")
        if not sep:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", size) or "warc-type" not in fields:
        return None
    begin, stop = end + 4, end + 4 + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        return None
    block = data[begin:stop]
    digest = fields.get("warc-block-digest")
    if digest and digest.lower().startswith("sha1:") and digest.upper() != _base32(hashlib.sha1(block).hexdigest()).upper():
        return None
    return fields, block, stop + 4 - at


class TooLarge(Exception):
    """A member holds more than the limit of one record."""


def _member_at(data: bytes, at: int, limit: int) -> tuple[bytes, int] | None:
    """Content and compressed size of the gzip member at ``at``; None if damaged.

    The member is fed to the decompressor in growing pieces, so that the rest of the archive
    is neither copied nor read for it.
    """
    engine, view, parts, made, end, step = zlib.decompressobj(31), memoryview(data), [], 0, at, FIRST_PIECE
    while not engine.eof:
        if end >= len(data):
            return None
        piece = view[end:end + step]
        end, step = end + len(piece), min(step * 2, LAST_PIECE)
        try:
            parts.append(engine.decompress(piece, limit + 1 - made))
        except zlib.error:
            return None
        made += len(parts[-1])
        if made > limit:
            raise TooLarge
    return b"".join(parts), end - at - len(engine.unused_data)


def _valid_at(data: bytes, at: int, limit: int):
    """(fields, block, size) of a valid record, () and size of an empty member, or None."""
    if data.startswith(MEMBER, at):
        member = _member_at(data, at, limit)
        if member is None:
            return None
        content, size = member
        if not content:
            return (), b"", size
        parsed = _parsed(content)
        return (parsed[0], parsed[1], size) if parsed and parsed[2] == len(content) else None
    if data.startswith(b"WARC/1.", at):
        return _parsed(data, at)
    return None


def _checked_at(data: bytes, at: int, limit: int):
    """``_valid_at`` and, if it is None, the reason."""
    try:
        found = _valid_at(data, at, limit)
    except TooLarge:
        return None, f"record of more than {limit} bytes"
    return found, ("damaged member" if data.startswith(MEMBER, at)
                   else "damaged record" if data.startswith(b"WARC/1.", at) else "no record")


_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def salvage(data: bytes, limit: int = 1 << 30):
    """Yield ``("record", offset, length, fields, block)`` and ``("gap", offset, length, reason)``.

    Every byte of ``data`` lies in one record, an empty member or one gap. ``limit``
    bounds the size of one uncompressed record; a larger one is a gap that says so.
    """
    at, data = 0, memoryview(data).tobytes()
    while at < len(data):
        found, reason = _checked_at(data, at, limit)
        if found is None:
            nxt = at + 1
            while True:
                begin = _BEGIN.search(data, nxt)
                if begin is None:
                    nxt = len(data)
                    break
                nxt = begin.start()
                if _checked_at(data, nxt, limit)[0] is not None:
                    break
                nxt += 1
            yield "gap", at, nxt - at, reason
            at = nxt
            continue
        fields, block, size = found
        if fields != ():
            yield "record", at, size, fields, block
        at += size


def _uri(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _file_records(batches):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema([(n, {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(),
                             "payload": pa.binary()}.get(n, pa.string())) for n in names])
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, held = [], 0
            for item in salvage(content.as_py() or b""):
                kind, offset, length = item[:3]
                row = dict.fromkeys(names) | {"file": name, "offset": offset, "length": length, "kind": kind}
                if kind == "gap":
                    row["reason"] = item[3]
                else:
                    fields, block = item[3:]
                    digest = fields.get("warc-payload-digest", "")
                    if digest.lower().startswith("sha1:"):
                        digest = base64.b32decode(digest[5:].upper()).hex()
                    size = fields.get("x-payload-length", "")
                    row |= {"record_type": fields["warc-type"], "record_id": _uri(fields.get("warc-record-id")),
                            "target_uri": fields.get("warc-target-uri"), "refers_to": _uri(fields.get("warc-refers-to")),
                            "payload_digest": digest or None, "payload": block,
                            "payload_bytes": int(size) if size.isdigit() else len(block)}
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= 256 or held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path`` (see RECORDS).

    ``kind`` is ``record`` or ``gap``; gaps carry file, offset, length and reason.
    Empty archives give no rows. ``payload`` of a revisit is empty, its
    ``payload_bytes`` and ``payload_digest`` describe the full payload.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_file_records, RECORDS)


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the page records."""
    number = lambda c: F.regexp_extract(c, f"^{RECORD_ID}(-?[0-9]+)$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    return records.where("kind = 'record' and record_type in ('response', 'revisit')").select(
        as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        as_id("refers_to").alias("refers_to"))
