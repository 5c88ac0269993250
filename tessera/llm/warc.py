"""WARC archives: a writer with payload dedup and a salvaging reader.

Writing.  Each row becomes one record in its own gzip member.  Of rows whose
payloads are equal and at least ``MIN_DEDUP`` bytes long, the one with the
smallest id is a ``response``; the others are ``revisit`` records that refer to
it and carry no payload.  Archives go to a folder on a file system that all
executors share; each task writes under a temporary name and renames at its
end, so a task that runs again leaves one whole file.

Reading.  Archives come through Spark's binary reader.  Every record is checked:
gzip CRC, version line, headers, content length, block end, payload digest.
After a failed check the reader looks for the next gzip member that opens with a
version line, or in plain archives for the next version line, goes on there, and
logs the bytes in between as a gap.  A member may hold any number of records: they
carry the member's byte range, and after a bad one the next version line inside the
member is searched; the log then names the range within the member's contents.
:func:`round_trip` fails if fewer records come back than were written.

Folders: a path without a scheme is one of Hadoop's default file system, as everywhere
in Spark; ``s3a://`` and ``s3n://`` are written through Arrow's S3 file system, which
takes its credentials from the executors' environment.

Defined cases: a null payload is empty; a null id is written as ``null`` and
reads back as null; a null url leaves the header out; control characters in a
url are percent-encoded; rows with the same id and payload are all responses if
that id is the smallest; empty archives and an empty table give empty results.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.session import scratch_path
from tessera.sources.fs import qualified

#: Payloads of fewer bytes are always written out.
MIN_DEDUP = 100
#: Copies of the table of repeated payloads, so that one payload's rows meet it in many tasks.
SALT = 16
#: Compressed bytes after which a task starts its next archive file.
ROLL = 16 << 20
#: Payload bytes of one Arrow batch that the reader hands on.
BATCH = 8 << 20
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classify(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
             min_dedup: int = MIN_DEDUP) -> DataFrame:
    """``id, url, payload, digest, n_bytes, refers_to``; ``refers_to`` is null for a response.

    Only (digest, smallest id) of payloads that occur more than once meet the
    rows, salted by id, so payloads shuffle once and a common one is spread.
    """
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        body.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "n_bytes": F.length("payload").cast("long")})
    again = (rows.where(F.col("n_bytes") >= min_dedup).groupBy("digest")
             .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    joined = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
              .join(again, ["digest", "salt"], "left"))
    later = (F.col("n_bytes") >= min_dedup) & ~F.col("id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    return joined.select("id", "url", "payload", "digest", "n_bytes",
                         F.when(later, F.col("first_id")).alias("refers_to"))


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record: version line, headers, empty line, block, two line ends."""
    block = b"" if refers_to is not None else payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    return _VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def arrow_uri(path: str) -> str:
    """A Hadoop URI as Arrow's file systems name it."""
    return re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]://", "s3://", path))


def write(classified: DataFrame, path: str) -> int:
    """Writes the archives under ``path``; the number of records.

    The count is an action, so the files are there when it returns.
    """
    uri = arrow_uri(qualified(classified.sparkSession, path))

    def run(batches):
        system, root = fs.FileSystem.from_uri(uri)
        system.create_dir(root, recursive=True)
        part, at = TaskContext.get().partitionId(), 0
        out, tmp, size, n = None, "", 0, 0

        def close():
            out.close()
            system.move(tmp, f"{root}/part-{part:06d}-{at:04d}.warc.gz")

        for b in batches:
            for i, u, p, d, r in zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    tmp, size = f"{root}/_tmp-{uuid.uuid4().hex}", 0
                    out = system.open_output_stream(tmp)
                m = _member(record_bytes(i, u, p, d, r))
                out.write(m)
                size, n = size + len(m), n + 1
                if size >= ROLL:
                    close()
                    out, at = None, at + 1
        if out is not None:
            close()
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return classified.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


class _Bad(Exception):
    pass


def _parse(raw: bytes, at: int):
    """Record at ``at`` of plain bytes: (fields, payload, end)."""
    stop = raw.find(b"\r\n\r\n", at)
    if not raw.startswith(b"WARC/1.", at) or stop < 0:
        raise _Bad("no version line or header end")
    lines = raw[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
    head = {}
    for line in lines:
        k, colon, v = line.partition(":")
        if not colon:
            raise _Bad("header line")
        head[k.strip().lower()] = v.strip()
    if not head.get("content-length", "").isdigit() or "warc-type" not in head:
        raise _Bad("content length or type")
    lo = stop + 4
    hi = lo + int(head["content-length"])
    if raw[hi:hi + 4] != b"\r\n\r\n":
        raise _Bad("block end")
    block = raw[lo:hi]
    digest = head.get("warc-payload-digest", "")
    if head["warc-type"] == "response" and digest.startswith("sha256:") \
            and hashlib.sha256(block).hexdigest() != digest[7:].lower():
        raise _Bad("payload digest")
    return head, block, hi + 4


def _inside(raw: bytes):
    """What a member's contents hold, as :func:`scan` yields it, with places in ``raw``."""
    at, bad, why = 0, -1, ""
    while at < len(raw):
        try:
            head, block, end = _parse(raw, at)
        except _Bad as e:
            if bad < 0:
                bad, why = at, str(e)
            at = raw.find(b"WARC/1.", at + 1)
            at = len(raw) if at < 0 else at
            continue
        if bad >= 0:
            yield "gap", bad, at, why, None
            bad = -1
        yield "record", at, end, head, block
        at = end
    if bad >= 0 or not raw:
        yield "gap", max(bad, 0), at, why or "empty member", None


def scan(raw: bytes):
    """Yields ``("record", start, end, headers, block)`` and ``("gap", start, end, why, None)``."""
    at, bad, why = 0, -1, ""
    size = len(raw)
    while at < size:
        try:
            if raw.startswith(b"\x1f\x8b", at):
                z = zlib.decompressobj(31)
                window, parts, pos = 1 << 16, [], at
                while not z.eof and pos < size:
                    parts.append(z.decompress(raw[pos:pos + window]))
                    pos += window
                if not z.eof:
                    raise _Bad("member cut short")
                found = list(_inside(b"".join(parts)))
                if found[0][0] == "gap" and len(found) == 1:
                    raise _Bad(found[0][3])
                nxt = min(pos, size) - len(z.unused_data)
                found = [(kind, at, nxt, f"{head}, bytes {lo} to {hi} of the member" if kind == "gap" else head, block)
                         for kind, lo, hi, head, block in found]
            else:
                head, block, nxt = _parse(raw, at)
                found = [("record", at, nxt, head, block)]
        except (_Bad, zlib.error) as e:
            if bad < 0:
                bad, why = at, str(e)
            at = _next(raw, at + 1)
            continue
        if bad >= 0:
            yield "gap", bad, at, why, None
            bad = -1
        yield from found
        at = nxt
    if bad >= 0:
        yield "gap", bad, size, why, None


def _next(raw: bytes, at: int) -> int:
    """Next place where a member that opens with a version line, or a version line, starts."""
    plain = raw.find(b"WARC/1.", at)
    while True:
        member = raw.find(b"\x1f\x8b\x08", at)
        if member < 0 or 0 <= plain < member:
            return plain if plain >= 0 else len(raw)
        try:
            if zlib.decompressobj(31).decompress(raw[member:member + 512], 16).startswith(b"WARC/1."):
                return member
        except zlib.error:
            pass
        at = member + 1


_SCHEMA = ("archive string, start long, stop long, gap string, warc_type string, record_id string, url string, "
           "refers_to string, payload_digest string, payload_length long, payload binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``.

    Rows with ``gap`` not null are quarantined byte ranges ``start, stop`` of
    ``archive``; the others are records.  ``payload_digest`` and
    ``payload_length`` of a response are computed from its block; those of a
    revisit are what its headers say of the payload it refers to.  An archive is
    read by one task (gzip cannot be split), at the writer's size of 16 MB.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true")
             .load(path).select("path", "content"))

    def run(batches):
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
        rows, held = [], 0

        def flush():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for i in range(b.num_rows):
                name, raw = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                for kind, lo, hi, head, block in scan(raw):
                    if kind == "gap":
                        rows.append((name, lo, hi, head, *[None] * 7))
                        continue
                    digest = head.get("warc-payload-digest", "").partition(":")[2].lower()
                    length = head.get("warc-payload-length", "")
                    full = head["warc-type"] == "response"
                    rows.append((name, lo, hi, None, head["warc-type"], head.get("warc-record-id"),
                                 head.get("warc-target-uri"), head.get("warc-refers-to"),
                                 hashlib.sha256(block).hexdigest() if full else digest,
                                 len(block) if full else int(length) if length.isdigit() else None, block))
                    held += len(block) + 500
                    if held >= BATCH:
                        yield flush()
                        rows, held = [], 0
        if rows:
            yield flush()

    return files.mapInArrow(run, _SCHEMA)


def tally(spark: SparkSession, path: str) -> tuple[int, int]:
    """Records and gaps of all archives under ``path``; no payload leaves its task."""
    row = read(spark, path).select("gap").agg(F.count(F.lit(1)).alias("n"), F.count("gap").alias("gaps")).first()
    return row["n"] - row["gaps"], row["gaps"]


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
               path: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives and reads them back: one row per record, with the integer ids.

    The archives are read once for their count before the rows are handed on; a gap or a
    missing record is an error.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    n = write(classify(pages, id_col, payload_col, url_col), path)
    if not n:
        return spark.createDataFrame([], "page_id long, warc_type string, refers_to long, payload_digest string, "
                                         "payload_length long, payload binary")
    if tally(spark, path) != (n, 0):
        raise RuntimeError(f"{n} records written to {path}, but {tally(spark, path)} records and gaps read")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return (read(spark, path).where(F.col("gap").isNull())
            .select(number("record_id").alias("page_id"), "warc_type", number("refers_to").alias("refers_to"),
                    "payload_digest", "payload_length", "payload"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM r
"""
