"""WARC archives: writing, and reading by verified record boundaries.

Writing: one record per row, payload in an HTTP response; of equal payloads the one with the smallest id is
a full response, the others are revisits without payload.  Records are made by column expressions and
written by Spark's text writer, so tasks commit their files as any Spark job does.

Reading: files are cut into ranges.  A task finds every place in its range that looks like a record start
and the place where that record would end (its successor); the magic may also stand inside a payload.
Successors are followed inside the range first, so a candidate points to the first candidate beyond the
range; pointer jumping over these from the start of each file, doubling the distance every round, gives the
true first record of each range.  A second pass reads the ranges from there, one record at a time: what the
chain does not reach is never a record.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.llm.common import materialise

MAGIC = b"WARC/1.1\r\n"
#: Tasks that ranges are dealt to at most; AQE would put these few narrow rows into one.
MAX_TASKS = 20_000
#: Bytes in a range, and bytes read first for a record head; further steps double what has been read.
RANGE_BYTES, HEAD_FIRST = 8 << 20, 2048
DATE = "2020-01-01T00:00:00Z"
_ID = "urn:x-page:"
#: Bytes of payload that a reading task holds before it passes rows on.
FLUSH_BYTES = 8 << 20


@F.arrow_udf(T.StringType())
def _base32(column: pa.Array) -> pa.Array:
    return pa.array([None if not x.is_valid else base64.b32encode(x.as_py()).decode() for x in column], pa.string())


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value.  Line breaks inside a value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(name + ": "), safe, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html") -> DataFrame:
    """One column ``value`` with the record of each row, without the last line feed."""
    p = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("body"))
    p = p.withColumn("bytes", F.octet_length("body")).withColumn("key", F.sha2(F.col("body").cast("binary"), 256))
    first = (p.where(F.col("bytes") >= min_revisit_bytes).groupBy("key").agg(F.min("order").alias("first"),
                                                                           F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").select("key", F.col("first").cast("string").alias("first")))
    # Written first, so that Spark knows its size: it is broadcast below the session's threshold, and only with
    # very many groups of copies are payloads shuffled.
    p = p.join(materialise(first, "copies"), "key", "left").withColumn("revisit", F.coalesce(F.col("id") != F.col("first"), F.lit(False)))
    p = p.withColumn("digest", _base32(F.unhex(F.sha1(F.col("body").cast("binary")))))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), head).otherwise(F.concat(head, "body"))
    return p.withColumn("block", block).select(F.concat(
        F.lit(MAGIC.decode()),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), F.coalesce("id", F.lit("")), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit(f"<{_ID}"), "first", F.lit(">")))),
        _line("WARC-Profile", F.when(F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), "block", F.lit("\r\n\r")).alias("value"))


def write_warc(pages: DataFrame, path: str, **options) -> None:
    """Archives under ``path``: one file per task, whole records, uncompressed so that ranges can be read."""
    records(pages, **options).write.option("lineSep", "\n").text(path)


def _open(uri: str):
    local = uri[len("file:"):] if uri.startswith("file:") else uri
    if local.startswith("/"):
        local = "/" + local.lstrip("/")
        return fs.LocalFileSystem().open_input_file(local)
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(path)


def _head(f, at: int) -> tuple[int, int, dict[str, str]] | None:
    """(block start, block length, fields) of the record at ``at``; None if none can start there."""
    raw = f.read_at(HEAD_FIRST, at)
    if not raw.startswith((MAGIC, b"WARC/1.0\r\n")):
        return None
    seen = 0
    while (end := raw.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
        seen = len(raw)
        more = f.read_at(seen, at + seen)
        if not more:  # the file ends
            return None
        raw += more
    fields = {}
    for line in raw[:end].split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    return (at + end + 4, int(length), fields) if length.isdigit() else None


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, size, lo, hi)`` of the ranges of all archives under ``path``; contents are not read here."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .where(F.col("length") > 0).select("path", F.col("length").alias("size")))
    cut = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1,
                                                            F.lit(range_bytes).cast("long"))).alias("lo"))
    return cut.withColumn("hi", F.least(F.col("lo") + range_bytes, F.col("size")))


def _dealt(rows: DataFrame, *cols: str) -> DataFrame:
    return rows.repartition(max(1, min(rows.count(), MAX_TASKS)), *cols)


def candidate_exits(cut: DataFrame) -> DataFrame:
    """``(path, at, out)``: for each candidate record start, the first place at or beyond its range's end that
    its chain of successors reaches; no row if the chain breaks inside the range."""

    def run(batches):
        for batch in batches:
            for path, size, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                found: list[tuple[int, int]] = []
                with _open(path) as f:
                    raw, at = f.read_at(hi - lo + len(MAGIC), lo), -1
                    while (at := raw.find(b"WARC/1.", at + 1)) >= 0 and at < hi - lo:
                        head = _head(f, lo + at)
                        if head:
                            found.append((lo + at, head[0] + head[1] + 4))
                exits: dict[int, int] = {}
                for at, nxt in reversed(found):
                    out = nxt if nxt >= hi else exits.get(nxt, -1)
                    if out >= 0:
                        exits[at] = out
                ats = list(exits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(ats), pa.string()), pa.array(ats, pa.int64()),
                     pa.array(list(exits.values()), pa.int64())], names=["path", "at", "out"])

    return _dealt(cut.select("path", "size", "lo", "hi"), "path", "lo").mapInArrow(run, "path string, at long, out long")


def entry_points(cut: DataFrame) -> DataFrame:
    """``(path, at)``: the record starts at which the chain from the start of each file enters a range."""
    jumps = materialise(candidate_exits(cut), "exits")
    reached = materialise(cut.where("lo = 0").select("path", F.col("lo").alias("at")), "entries")
    most = cut.groupBy("path").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).head()[0]
    for _ in range(int(most).bit_length()):
        further = reached.join(jumps, ["path", "at"]).select("path", F.col("out").alias("at"))
        reached = materialise(reached.union(further).distinct(), "entries")
        onward = jumps.select("path", F.col("at").alias("out"), F.col("out").alias("beyond"))
        # A chain that ends or breaks before the doubled distance has no jump of that length, but the chain of
        # half the length is followed above, so no reachable range is lost.
        jumps = materialise(jumps.join(onward, ["path", "out"]).select("path", "at", F.col("beyond").alias("out")),
                            "exits")
    return reached


_SCHEMA = ("path string, at long, record_type string, record_id string, refers_to string, target_uri string, "
           "payload_digest string, payload_bytes long, intact boolean, payload binary")


def read_records(cut: DataFrame, entries: DataFrame, range_bytes: int, with_payload: bool = True) -> DataFrame:
    """The records that start in each range, read in order from the range's entry point."""

    def run(batches):
        rows: list[tuple] = []
        held = 0
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("record_type", pa.string()),
                            ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("intact", pa.bool_()),
                            ("payload", pa.binary())])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for path, hi, size, at in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(path) as f:
                    while at < hi and (head := _head(f, at)):
                        start, length, fields = head
                        if start + length > size:
                            break
                        block = f.read_at(length, start)
                        top, _, body = block.partition(b"\r\n\r\n")
                        said = dict(x.lower().split(b": ", 1) for x in top.split(b"\r\n")[1:] if b": " in x)
                        n = int(said.get(b"content-length", len(body)))
                        payload = body if with_payload else None
                        kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        intact = not body if kind == "revisit" else (
                            n == len(body) and base64.b32encode(hashlib.sha1(body).digest()).decode() == digest)
                        rows.append((path, at, kind, fields.get("warc-record-id", "").strip("<>"),
                                     fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                                     fields.get("warc-target-uri"),
                                     digest, n, intact, payload))
                        held += len(payload or b"") + 256
                        if held > FLUSH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                        at = start + length + 4
        if rows:
            yield batch_of(rows)

    step = F.col("at") - F.pmod("at", F.lit(range_bytes).cast("long"))
    known = materialise(cut.join(entries.withColumn("lo", step), ["path", "lo"]).select("path", "hi", "size", "at"),
                        "entries")
    return _dealt(known, "path", "at").mapInArrow(run, _SCHEMA)


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``.

    A file is read from its start as long as records follow one another; after damage the rest of that file
    has no verified start and gives no rows, and a record cut off by the file's end is left out.  Empty files
    give no rows.  ``payload`` is the HTTP body as stored (empty for a revisit); ``payload_bytes`` the full
    payload's length as the HTTP head states it.
    """
    cut = materialise(ranges(spark, path, range_bytes), "ranges")
    return read_records(cut, entry_points(cut), range_bytes, with_payload)


def page_records(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives under ``path`` and read them back: ``(page_id, payload_bytes,
    payload_digest, record_type, refers_to, intact)``.

    A null html is an empty payload; a null url has no target line; a null id is kept and never referred to.
    Rows that repeat both the payload and its smallest id are responses all.  An empty table gives no rows; extra
    columns are not looked at, whatever their names.
    """
    write_warc(pages, path, min_revisit_bytes=min_revisit_bytes)
    got = read_warc(pages.sparkSession, path, with_payload=False)
    kind = pages.schema["page_id"].dataType

    def page(c: str) -> Column:
        return F.nullif(F.substring(F.col(c), len(_ID) + 1, 1 << 20), F.lit("")).cast(kind)

    return got.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      page("refers_to").alias("refers_to"), "intact")
