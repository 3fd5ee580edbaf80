"""WARC archives: write pages with revisits, read back by boundary chains.

Writing. Every row becomes one WARC/1.1 record with its payload in UTF-8
(null: empty). Of the rows with equal payloads of ``min_bytes`` or more the
one with the largest id is a ``response`` and the others are ``revisit``
records that name it; smaller payloads are all ``response``. Spark's text
writer makes the files: one archive per task, its line separator being the
blank lines between records, so commits and retries are Spark's own.

Reading. Archives are read in splits, wherever they lie. The record magic is
the reader's line separator, so each line is a candidate record and the lines
of a file, laid end to end, are the file:

1. every task emits, per split, its length and for every candidate the offset
   at which the chain of Content-Lengths that starts there leaves the split;
2. running totals of the lengths give offsets in the file; pointer jumping
   over the few offsets at which chains enter a split, from the file's start,
   keeps the entries that are reachable: log2(splits of a file) rounds;
3. the splits are read again from their reachable entry on. Whatever the
   chain steps over is payload, even where it looks like a record. A payload
   that crosses splits comes together from its fragments.

The driver holds two numbers per split (it planned those splits itself).
Splits must be the same in both readings, so the read is pinned to one
partition count, and a split that is not known raises.

Defined results: rows with the same id and equal payloads are all the
response; a null id is smaller than any other and is written as absent;
CR and LF in a url are percent-encoded, a null url is left out; an empty
table makes an empty archive; a record that the file ends within, and all
after a broken chain, are left out. Columns other than the three are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, materialize, remove, scratch_path, shuffle_partitions

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
_M, _B = len(MAGIC), len(BLANK)


# -- writing ------------------------------------------------------------------

def _squeeze(payload: pd.Series) -> pd.Series:
    return payload.map(zstandard.ZstdCompressor(level=6, write_checksum=False).compress)


def _expand(squeezed: pd.Series) -> pd.Series:
    return squeezed.map(zstandard.ZstdDecompressor().decompress)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_bytes: int = 1000, salts: int = 16) -> None:
    """Write ``pages`` as WARC files below ``path`` (a new folder).

    Payloads go through the one shuffle compressed; revisits leave theirs behind."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    url = F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1(F.col("payload").cast("binary"))})
    same = ["size", "sha1", "sha2"]
    large = F.col("size") >= min_bytes
    rows = rows.withColumn("sha2", F.when(large, F.sha2(F.col("payload").cast("binary"), 256)))
    first = rows.where(large).groupBy(*same).agg(
        F.max(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    packed = rows.withColumn("payload", F.pandas_udf(_squeeze, "binary")(F.col("payload").cast("binary")))
    rows = attach_salted(packed, first, same, F.struct("id", "url"), salts)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))

    def uuid(id_, url_):
        h = F.md5(F.concat_ws("|", id_.cast("string"), url_, F.col("sha1")))
        return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", uuid(F.col("id"), F.col("url"))),
        line("WARC-Target-URI", F.col("url")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        line("WARC-Refers-To", F.when(revisit, uuid(F.col("first.id"), F.col("first.url")))),
        line("X-Page-Id", F.col("id")),
        line("X-Refers-To-Page", F.when(revisit, F.col("first.id"))),
        line("X-Payload-Bytes", F.when(revisit, F.col("size"))),
        F.lit("Content-Type: text/html\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string"), F.lit(BLANK))
    body = F.when(revisit, F.lit("")).otherwise(F.pandas_udf(_expand, "binary")(F.col("payload")).cast("string"))
    rows.select(F.concat(head, body).alias("value")).write.option("lineSep", BLANK).text(path)


# -- reading ------------------------------------------------------------------

def parse_header(chunk: bytes) -> tuple[int, int, dict[str, str]] | None:
    """(header length with its blank line, content length, fields) of what
    follows a magic, or None if that is no record header."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for row in chunk[:end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()) or "warc-type" not in fields:
        return None
    return end + 4, int(length), fields


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], bytes | None]]:
    """((file, block start, file size), line) in order; a None line ends a split."""
    now = None
    for batch in batches:
        cols = [batch.column(i) for i in range(4)]
        for path, start, size, value in zip(*cols):
            key = (path.as_py(), start.as_py(), size.as_py())
            if now is not None and key != now:
                yield now, None
            now = key
            yield key, value.as_py()
    if now is not None:
        yield now, None


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split its length (at = -1) and per candidate where its chain leaves
    the split. Offsets are those of the text after a magic, from the split's start."""
    names = ["file", "block", "at", "leaves"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [(), (), (), ()]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    at, after = 0, {}
    for (path, block, _), line in _splits(batches):
        if line is not None:
            head = parse_header(line)
            if head:
                after[at] = at + head[0] + head[1] + _B + _M
            at += len(line) + _M
            continue
        leaves: dict[int, int] = {}
        for start in sorted(after, reverse=True):
            to = after[start]
            if to >= at:
                leaves[start] = to
            elif to in leaves:
                leaves[start] = leaves[to]
        rows = [(path, block, -1, at), *((path, block, a, b) for a, b in leaves.items())]
        for i in range(0, len(rows), 50_000):
            yield table(rows[i : i + 50_000])
        at, after = 0, {}


def _entries(chains: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """(file, block) -> (offset of the split, reachable entry in it or -1)."""
    spark = chains.sparkSession
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = chains.where("at = -1").select(
        "file", "block", F.coalesce(F.sum("leaves").over(order), F.lit(0)).alias("base"))
    splits = materialize(splits, "warc-splits")
    nodes = chains.where("at >= 0").join(splits, ["file", "block"]).select(
        "file", "block", (F.col("base") + F.col("at")).alias("a"), (F.col("base") + F.col("leaves")).alias("b"))
    # only where a chain enters a split, or a file begins, can an entry be
    enters = nodes.select("file", F.col("b").alias("a")).distinct()
    starts = splits.where("base = 0").select("file", F.lit(_M).cast("long").alias("a")).distinct()
    jump = materialize(nodes.join(enters.union(starts).distinct(), ["file", "a"], "left_semi"), "warc-jump")
    at_entry = jump.select("file", "block", "a")
    reached = materialize(jump.join(starts, ["file", "a"], "left_semi").select("file", "a"), "warc-reached")
    jump = jump.select("file", "a", "b")
    count = reached.count()
    while True:
        step = reached.join(jump, ["file", "a"]).select("file", F.col("b").alias("a")).join(
            at_entry.select("file", "a"), ["file", "a"], "left_semi")
        more = materialize(reached.union(step).distinct(), "warc-reached")
        now = more.count()
        if now == count:
            break
        onward = jump.select("file", F.col("a").alias("b"), F.col("b").alias("c"))
        jump = materialize(jump.join(onward, ["file", "b"]).select("file", "a", F.col("c").alias("b")), "warc-jump")
        reached, count = more, now
    entry = at_entry.join(reached, ["file", "a"], "left_semi").groupBy("file", "block").agg(F.min("a").alias("a"))
    rows = splits.join(entry, ["file", "block"], "left").collect()
    return {(r["file"], r["block"]): (r["base"], -1 if r["a"] is None else r["a"]) for r in rows}


RECORD = ("file string, record_offset long, page_id long, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long, uri string, declared_digest string, payload binary")
FRAGMENT = "piece_at long, piece binary, content_length long"


def _reader(entries: dict[tuple[str, int], tuple[int, int]], keep_payload: bool):
    """Reads splits from their entries. A payload that goes on after its split
    leaves as fragments: what the record has, and what later splits have."""
    names = [f.split()[0] for f in (RECORD + ", " + FRAGMENT).split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]

    def record(path: str, offset: int, fields: dict, body: bytes | None) -> tuple:
        def number(name: str) -> int | None:
            value = fields.get(name)
            return int(value) if value is not None else None

        kind, declared = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "revisit":
            size, digest = number("x-payload-bytes"), declared
        elif body is None:  # its fragments have the payload
            size, digest = None, None
        else:
            size, digest = len(body), hashlib.sha1(body).hexdigest()
        return (path, offset, number("x-page-id"), size, digest, kind, number("x-refers-to-page"),
                fields.get("warc-target-uri"), declared, body if keep_payload and kind != "revisit" else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        at, due, key = 0, -1, None
        open_record: tuple | None = None  # offset, fields, length and end of payload, pieces so far
        for key, line in _splits(batches):
            path, block, size = key
            base, entry = entries[path, block]
            if line is None:
                if open_record:  # goes on in another split
                    offset, fields, content, _, pieces = open_record
                    out.append((*record(path, offset, fields, None), offset, b"".join(pieces), content))
                at, due, open_record = 0, -1, None
                continue
            start = base + at
            at += len(line) + _M
            if due < 0 and start != entry:
                if start >= _M:  # before the entry: inside a payload from an earlier split
                    none = (None,) * (len(types) - 5)
                    out.append((path, None, *none, start, MAGIC.encode() + line, None))
            elif due < 0 or start == due:
                head = parse_header(line)
                open_record = None
                if head is None:  # the chain is broken
                    due = 1 << 62
                    continue
                length, content, fields = head
                end = start + length + content
                due = end + _B + _M
                if end > size:
                    due = 1 << 62
                elif length + content <= len(line):
                    out.append((*record(path, start - _M, fields, line[length : length + content]), None, None, None))
                else:
                    open_record = (start - _M, fields, content, end, [line[length:]])
            elif open_record:
                offset, fields, content, end, pieces = open_record
                pieces += [MAGIC.encode(), line]
                if start + len(line) >= end:
                    out.append((*record(path, offset, fields, b"".join(pieces)[:content]), None, None, None))
                    open_record = None
            if len(out) >= 5000:
                yield emit()
        yield emit()

    return run, f"{RECORD}, {FRAGMENT}"


def _join_fragments(parts: DataFrame, keep_payload: bool) -> DataFrame:
    """Records whose payload crosses splits, whole. A fragment belongs to the
    last open record before it in its file."""
    order = Window.partitionBy("file").orderBy("piece_at").rowsBetween(Window.unboundedPreceding, 0)
    owned = parts.where("piece is not null").withColumn(
        "owner", F.last("record_offset", ignorenulls=True).over(order))
    fields = [f.split()[0] for f in RECORD.split(", ")]
    whole = owned.where("owner is not null").groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("piece_at", "piece"))).alias("pieces"),
        *[F.max(c).alias(c) for c in fields if c not in ("file", "payload")],
        F.max("content_length").alias("n"))
    body = F.substring(F.concat_ws("", F.transform("pieces", lambda p: F.hex(p["piece"]))), F.lit(1), F.col("n") * 2)
    whole = whole.withColumn("body", F.unhex(body)).where(F.octet_length("body") == F.col("n"))
    return whole.withColumns({
        "payload_bytes": F.col("n"), "payload_digest": F.sha1("body"),
        "payload": F.col("body") if keep_payload else F.lit(None).cast("binary")}).select(*fields)


def read_warc(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """The records that boundary chains reach: file, record_offset, page_id,
    payload_bytes, payload_digest, record_type, refers_to, uri, declared_digest, payload."""
    pin = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(pin, None)
    spark.conf.set(pin, str(shuffle_partitions(spark)))
    try:
        lines = spark.read.option("lineSep", MAGIC).text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))
        chains = materialize(lines.mapInArrow(_chains, "file string, block long, at long, leaves long"), "warc-chains")
        run, schema = _reader(_entries(chains), keep_payload)
        parts = materialize(lines.mapInArrow(run, schema), "warc-records")
    finally:
        if before is None:
            spark.conf.unset(pin)
        else:
            spark.conf.set(pin, before)
    fields = [f.split()[0] for f in RECORD.split(", ")]
    whole = parts.where("piece is null").select(*fields)
    if parts.where("piece is not null").isEmpty():
        return whole
    return whole.unionByName(_join_fragments(parts, keep_payload))


def archive_round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, min_bytes=min_bytes)
    records = read_warc(spark, path)
    remove(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
