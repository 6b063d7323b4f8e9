"""WARC fixity audit by Merkle trees.

A store is a folder of archives, each of up to ARCHIVE_RECORDS records in order, every record a gzip member of its own
(the usual form of compressed WARC). A leaf is the hash of a record, with its place and offsets in the uncompressed
archive, all read back from the store; a node hashes the offset ranges and hashes of up to FAN nodes below it, in order.
Two replicas are compared from their roots: only below nodes that differ are the next ones read, so an audit of sound
replicas compares one row, and a damaged record costs FAN rows a level. A record that a replica lacks shifts those after
it in its archive, not in others.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.ranking import global_rank
from .common import lean, materialize, release, scratch_dir, small_batches
from .media import _fs

FAN = 16
ARCHIVE_RECORDS = 1000
#: Archives that one task reads, at most; stored bytes that it reads at once.
TASK_ARCHIVES = 256
PIECE = 1 << 16
LISTED = "archive long, file string, records long"
LEAF = "archive long, seq long, offset long, length long, hash string, whole boolean"


def warc_record(url: Column, name: Column, body: Column) -> Column:
    """A response record as text; nulls are empty."""
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    head = [F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), empty(url), F.lit("\r\nWARC-Record-ID: <urn:page:"), empty(name), F.lit(">\r\nContent-Length: "), F.octet_length(empty(body)).cast("string")]
    return F.concat(*head, F.lit("\r\n\r\n"), empty(body), F.lit("\r\n\r\n"))


def parse_warc(files: DataFrame) -> DataFrame:
    """binaryFile rows (path, content) -> archive, seq, offset, length, record: every record of uncompressed archives.

    A record that is cut short, or without a length, ends its archive with a row whose record is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "seq", "offset", "length", "record"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                data, at, seq, rows = content.as_py() or b"", 0, 0, []
                while at < len(data):
                    end = data.find(b"\r\n\r\n", at)
                    size = [h.partition(b":")[2].strip() for h in data[at : max(end, at)].split(b"\r\n") if h.lower().startswith(b"content-length:")]
                    stop = end + 8 + int(size[0]) if end >= 0 and size and size[0].isdigit() else len(data) + 1
                    ok = stop <= len(data) and data[stop - 4 : stop] == b"\r\n\r\n"
                    rows.append((path, seq, at, (stop if ok else len(data)) - at, data[at:stop] if ok else None))
                    at, seq = stop if ok else len(data), seq + 1
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return files.select("path", "content").mapInArrow(run, "archive string, seq long, offset long, length long, record binary")


# ---- stores --------------------------------------------------------------------------------------------------------


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, t in enumerate(types)], list(names))


def deflated(record: bytes) -> bytes:
    """A record as a gzip member without a time: equal records, equal bytes."""
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out.compress(record) + out.flush()


def stored_members(stream) -> Iterator[tuple[bytes, bytes | None]]:
    """(stored bytes, record) of each gzip member of a stream, one in memory at a time.

    Where a member is cut short or cannot be inflated, the last pair is (SHA-256 of all stored bytes from there, None).
    """
    rest = stream.read(PIECE)
    while rest:
        inflate, raw, plain = zlib.decompressobj(31), [], []
        try:
            while not inflate.eof:
                if not rest:
                    raise EOFError
                plain.append(inflate.decompress(rest))
                raw.append(rest[: len(rest) - len(inflate.unused_data)])
                rest = inflate.unused_data or stream.read(PIECE)
        except (zlib.error, EOFError):
            digest = hashlib.sha256(b"".join(raw))
            while rest:
                digest.update(rest)
                rest = stream.read(PIECE)
            yield digest.digest(), None
            return
        yield b"".join(raw), b"".join(plain)


def write_store(records: DataFrame, order: list[str], bounds: list[tuple], per_range: int, directory: str, per_archive: int = ARCHIVE_RECORDS) -> DataFrame:
    """Records (the columns of ``order``, which tell rows apart and have no nulls, and ``record``) as a store -> archive, file, records.

    ``bounds`` are the order's values of the records at places per_range, 2 * per_range and so on; per_range is a
    multiple of per_archive. So records are exchanged once, compressed, and no archive lies in two ranges, however many
    records are alike. A task writes under names of its own; only archives of tasks that ended well are listed.
    """
    spark = records.sparkSession
    small_batches(spark)
    width = len(order)

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [c.to_pylist() for c in b.columns[:width]]
            at = [bisect.bisect_right(bounds, k) for k in zip(*keys)]
            packed = [deflated(r.as_py().encode()) for r in b.column(width)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *b.columns[:width], pa.array(packed, pa.binary())], ["range", *order, "member"])

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _fs(directory)
        ctx, place, now, out, name, n = TaskContext.get(), 0, None, None, "", 0
        for b in batches:
            for r, member in zip(b.column(0).to_pylist(), b.column(1)):
                if r != now:
                    place, now = r * per_range, r
                if out is not None and place % per_archive == 0:
                    out.close()
                    yield _batch([(archive, name, n)], LISTED)
                    out = None
                if out is None:
                    archive, n = place // per_archive, 0
                    name = f"archive-{archive:09d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                out.write(member.as_py())
                place, n = place + 1, n + 1
        if out is not None:
            out.close()
            yield _batch([(archive, name, n)], LISTED)

    fs, top = _fs(directory)
    fs.create_dir(top)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.select(*order).schema)
    dealt = records.select(*order, "record").mapInArrow(deal, f"range int, {kinds}, member binary")
    sorted_ = dealt.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("range", *order)
    return materialize(sorted_.select("range", "member").mapInArrow(write, LISTED))


def _spread(listing: DataFrame) -> DataFrame:
    """Archives of a store over tasks, few to each."""
    n = listing.count()
    tasks = max(int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_ARCHIVES))
    return listing.select("archive", "file", "records").repartition(max(1, min(n, tasks)))


def copy_store(listing: DataFrame, source: str, target: str, change: Callable[[bytes], bytes | None] | None = None) -> DataFrame:
    """A replica of a store in another folder -> its archive, file, records. ``change`` gives another record in place of one,
    or None to copy the stored bytes as they are. A damaged archive is copied up to the damage."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, top), (b, to), ctx = _fs(source), _fs(target), TaskContext.get()
        for batch in batches:
            for archive, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name, n = f"archive-{archive:09d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz", 0
                with a.open_input_stream(f"{top}/{file}", compression=None) as i, b.open_output_stream(f"{to}/{name}", compression=None) as o:
                    for raw, record in stored_members(i):
                        if record is not None:
                            other = change(record) if change else None
                            o.write(raw if other is None else deflated(other))
                            n += 1
                yield _batch([(archive, name, n)], LISTED)

    fs, to = _fs(target)
    fs.create_dir(to)
    return materialize(_spread(listing).mapInArrow(run, LISTED))


def read_store(listing: DataFrame, directory: str) -> DataFrame:
    """Records of the listed archives as the store has them now -> archive, seq, offset, length, hash, whole.

    Offsets and lengths are those of the uncompressed archive. Where an archive is damaged beyond reading, its last row
    has the hash of the stored bytes left, length 0 and whole false; an archive whose file is gone is such a row alone.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _fs(directory)
        for batch in batches:
            for archive, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, at, seq = [], 0, 0
                try:
                    with fs.open_input_stream(f"{top}/{file}", compression=None) as i:
                        for raw, record in stored_members(i):
                            size = len(record or b"")
                            rows.append((archive, seq, at, size, raw.hex() if record is None else hashlib.sha256(record).hexdigest(), record is not None))
                            at, seq = at + size, seq + 1
                            if len(rows) >= 1000:
                                yield _batch(rows, LEAF)
                                rows = []
                except FileNotFoundError:
                    rows.append((archive, seq, at, 0, "", False))
                if rows:
                    yield _batch(rows, LEAF)

    return _spread(listing).mapInArrow(run, LEAF)


def leaves(found: DataFrame, per_archive: int = ARCHIVE_RECORDS) -> DataFrame:
    """Records of a store -> leaves of its tree; an archive has a run of per_archive nodes, so what it lacks shifts no other."""
    return found.select((F.col("archive") * per_archive + F.col("seq")).alias("node"), F.col("offset").alias("start"), "length", "hash")


# ---- trees ---------------------------------------------------------------------------------------------------------


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Leaves (node long, start long, length long, hash string), nodes from 0 -> levels from leaves to root; gaps are left out.

    Each level is a table of its own; a node gathers FAN children at most.
    """
    levels = [materialize(leaves.select("node", "start", "length", "hash"))]
    count = (levels[0].agg(F.max("node")).first()[0] or 0) + 1
    while count > 1:
        child = F.struct("node", "start", "length", "hash")
        kids = levels[-1].groupBy(F.expr(f"node div {FAN}").alias("node")).agg(F.array_sort(F.collect_list(child)).alias("kids"))
        text = F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["start"], k["length"], k["hash"])), "\n")
        levels.append(materialize(kids.select("node", F.col("kids")[0]["start"].alias("start"), F.aggregate("kids", F.lit(0).cast("long"), lambda a, k: a + k["length"]).alias("length"), F.sha2(text, 256).alias("hash"))))
        count = -(-count // FAN)
    return levels


def audit(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """Leaves that differ between two trees: node, start, length, hash_a, hash_b; the hash is null where a replica has no such leaf.

    Descends from the higher root; below, only children of nodes that differ are compared.
    """
    top = max(len(first), len(second)) - 1
    differing = None
    for level in range(top, -1, -1):
        pair = [t[level] if level < len(t) else t[0].limit(0) for t in (first, second)]
        if differing is not None:
            pair = [x.join(differing.select(F.col("node").alias("_up")), F.expr(f"node div {FAN}") == F.col("_up"), "left_semi") for x in pair]
        a = pair[0].select("node", *[F.col(c).alias(f"{c}_a") for c in ("start", "length", "hash")])
        b = pair[1].select("node", *[F.col(c).alias(f"{c}_b") for c in ("start", "length", "hash")])
        met = a.join(b, "node", "full").filter(~(F.col("hash_a").eqNullSafe(F.col("hash_b")) & F.col("start_a").eqNullSafe(F.col("start_b"))))
        differing = met.select("node", F.coalesce("start_a", "start_b").alias("start"), F.coalesce("length_a", "length_b").alias("length"), "hash_a", "hash_b")
        if level:
            differing = materialize(differing)
    return differing


def place(records: DataFrame, order: list[Column], per_archive: int = ARCHIVE_RECORDS) -> DataFrame:
    """Records with a length -> + node (place in the store), archive, seq and offset in the archive.

    Archives hold per_archive records by place in the store, so none is larger however ids are spread; offsets are
    sums within an archive.
    """
    from pyspark.sql import Window as W

    ranked = global_rank(records, order, "_rank").withColumn("node", F.col("_rank") - 1).drop("_rank")
    ranked = ranked.withColumn("archive", F.expr(f"node div {per_archive}")).withColumn("seq", F.col("node") % per_archive)
    before = W.partitionBy("archive").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return ranked.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


_HEAD = re.compile(rb">\r\nContent-Length: (\d+)\r\n\r\n")


def spoil(record: bytes) -> bytes | None:
    """Planted damage: the first character of the body is another one of the same length where the MD5 of the address starts
    with 00, 55 or aa; None for other records and for empty bodies."""
    for m in _HEAD.finditer(record):
        if m.end() + int(m[1]) + 4 == len(record):
            break
    else:
        return None
    url = record[record.index(b"WARC-Target-URI: ") + 17 : record.rindex(b"\r\nWARC-Record-ID: <urn:page:", 0, m.end())]
    if int(m[1]) == 0 or hashlib.md5(url).hexdigest()[:2] not in ("00", "55", "aa"):
        return None
    at = m.end()
    size = next(n for n in range(1, 5) if record[at + n] & 0xC0 != 0x80)
    return record[:at] + (b"%" if record[at : at + 1] == b"#" else b"#") * size + record[at + size :]


def page_store(spark: SparkSession, pages: DataFrame, directory: str, per_archive: int = ARCHIVE_RECORDS) -> tuple[DataFrame, DataFrame]:
    """All pages (page_id, url, html; read from files) as a store in the order of page_id, url and hash, nulls last
    -> (listing, (node, page_id)). Pages that repeat are told apart by their file and row."""
    whole = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    keys = [F.col("page_id").isNull().alias("k0"), F.coalesce("page_id", F.lit(0)).alias("k1"), F.col("url").isNull().alias("k2"), F.coalesce("url", F.lit("")).alias("k3"), F.sha2(whole, 256).alias("k4"), F.xxhash64("_metadata.file_path").alias("k5"), F.col("_metadata.row_index").alias("k6")]
    order = [f"k{i}" for i in range(len(keys))]
    placed = materialize(global_rank(pages.select(*keys), [F.col(k) for k in order], "_rank").withColumn("node", F.col("_rank") - 1).drop("_rank"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_range = -(-max(1, placed.count()) // (ranges * per_archive)) * per_archive
    bounds = sorted(tuple(r) for r in placed.filter((F.col("node") % per_range == 0) & (F.col("node") > 0)).select(*order).collect())  # fewer than there are shuffle partitions
    listing = write_store(pages.select(*keys, whole.alias("record")), order, bounds, per_range, directory, per_archive)
    return listing, placed.select("node", F.when(~F.col("k0"), F.col("k1")).alias("page_id"))


def op8_warc_fixity(spark, sf_dir: str) -> DataFrame:
    """Stores all pages as WARC archives, makes a damaged replica of the store, reads both back and audits them. In the
    replica the first character of the body is another one where md5(url) starts with 00, 55 or aa. Returns the records
    that the audit locates, with the archive, place and offset where the store has them.

    Null fields are empty; pages that repeat are records of their own; pages with an empty body cannot be damaged; an
    empty table gives no archive and no row.
    """
    folder = f"{scratch_dir(spark)}/fixity-{uuid.uuid4().hex}"
    first, names = page_store(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{folder}/a")
    second = copy_store(first, f"{folder}/a", f"{folder}/b", spoil)
    trees = [tree(leaves(read_store(listing, f"{folder}/{k}"))) for listing, k in ((first, "a"), (second, "b"))]
    release(spark, [folder])  # the trees are tables of their own
    found = audit(*trees).withColumn("archive", F.expr(f"node div {ARCHIVE_RECORDS}")).withColumn("seq", F.col("node") % ARCHIVE_RECORDS)
    return found.join(names, "node", "left").select("page_id", "archive", "seq", F.col("start").alias("offset"), "length", "hash_a", "hash_b")


ORACLE = """
WITH r AS (
  SELECT page_id, url, coalesce(html, '') AS body, chr(13) || chr(10) AS nl FROM pages),
h AS (
  SELECT *, 'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl || 'WARC-Record-ID: <urn:page:'
         || coalesce(CAST(page_id AS VARCHAR), '') || '>' || nl || 'Content-Length: ' || strlen(body) || nl || nl AS head, nl || nl AS tail,
         substring(md5(coalesce(url, '')), 1, 2) IN ('00', '55', 'aa') AND length(body) > 0 AS hit,
         repeat(CASE WHEN substring(body, 1, 1) = '#' THEN '%' ELSE '#' END, CAST(strlen(substring(body, 1, 1)) AS INTEGER)) || substring(body, 2) AS spoilt
  FROM r),
d AS (SELECT *, strlen(head) + strlen(body) + 4 AS length, sha256(head || body || tail) AS hash_a, sha256(head || spoilt || tail) AS hash_b FROM h),
n AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS LAST, url NULLS LAST, hash_a) - 1 AS node FROM d),
o AS (SELECT *, node // 1000 AS archive, node % 1000 AS seq, coalesce(sum(length) OVER (
        PARTITION BY node // 1000 ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offs FROM n)
SELECT page_id, CAST(archive AS BIGINT) AS archive, CAST(seq AS BIGINT) AS seq, CAST(offs AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, hash_a, hash_b FROM o WHERE hit
"""
