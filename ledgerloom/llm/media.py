"""Media columns: payloads in archive directories, read by a data source of byte ranges.

Payloads are stored losslessly as 8-bit grey samples (PNG, 64 samples a row) in ZIP archives, one set of archives a
write task. The ``archive_members`` data source plans byte ranges over all archives of a directory: a range owns the
members whose local header starts in it, which the archive's own directory tells. A member that cannot be read or does
not match its checksum is fetched again by its offset, independently of others; only after that is it reported, as a
row with an error, and the rest of the range goes on. Payloads travel in Arrow batches of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .blocks import split
from .common import lean, materialize, scratch_dir, small_batches

ROW = 64
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
TRIES = 3
LEVEL = 1
SCHEMA = "archive string, offset long, member string, content binary, error string"


def _fs(path: str):
    """File system of a path, local or of any store that Arrow knows, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# ---- samples -------------------------------------------------------------------------------------------------------


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def encode(data: bytes) -> bytes:
    """Bytes as a grey 8-bit PNG of ROW samples a row, zero-padded to a positive multiple of ROW; their number is kept aside."""
    n = len(data)
    height = max(1, -(-n // ROW))
    padded = np.zeros(height * ROW, np.uint8)
    padded[:n] = np.frombuffer(data, np.uint8)
    rows = np.zeros((height, ROW + 1), np.uint8)  # a filter byte 0 leads each row
    rows[:, 1:] = padded.reshape(height, ROW)
    return b"".join([
        b"\x89PNG\r\n\x1a\n", _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, height, 8, 0, 0, 0, 0)), _chunk(b"tEXt", b"n_bytes\0%d" % n),
        _chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)), _chunk(b"IEND", b""),
    ])


def decode(png: bytes) -> tuple[int, bytes]:
    """(number of bytes kept aside, payload with padding) of a PNG written by encode; checks every chunk."""
    if png[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, n, height, packed = 8, -1, 0, []
    while at < len(png):
        size = struct.unpack_from(">I", png, at)[0]
        kind, data = png[at + 4 : at + 8], png[at + 8 : at + 8 + size]
        if zlib.crc32(data, zlib.crc32(kind)) != struct.unpack_from(">I", png, at + 8 + size)[0]:
            raise ValueError("chunk does not match its checksum")
        if kind == b"IHDR":
            height = struct.unpack_from(">I", data, 4)[0]
        elif kind == b"tEXt":
            n = int(data.partition(b"\0")[2])
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, ROW + 1)
    return n, rows[:, 1:].tobytes()


def describe(payload: bytes) -> str:
    """Features of the samples: mean, deviation, entropy of levels, mean step between neighbours, share of zeros."""
    x = np.frombuffer(payload, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    step = np.abs(np.diff(x.astype(np.int16))).mean() if len(x) > 1 else 0.0
    return f"mean={x.mean():.4f};sd={x.std():.4f};entropy={abs(entropy):.4f};step={step:.4f};zero={p[0]:.4f}"


# ---- write ---------------------------------------------------------------------------------------------------------


def store(docs: DataFrame, directory: str, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """Write every row's text to archives in directory; returns (archive, members) of what was written.

    A task writes under a name of its own attempt; only archives named by a task that ended well are listed, so retries
    and lost executors leave no member twice.
    """
    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _fs(directory)
        ctx, serial = TaskContext.get(), 0
        out = None

        def opened():
            nonlocal serial
            name = f"part-{ctx.partitionId():05d}-{ctx.taskAttemptId()}-{serial:05d}-{uuid.uuid4().hex[:8]}.zip"
            serial += 1
            raw = fs.open_output_stream(f"{top}/{name}")
            return name, raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED), [0, 0]

        def closed(o):
            o[2].close()
            o[1].close()
            return pa.RecordBatch.from_arrays([pa.array([o[0]]), pa.array([o[3][0]], pa.int64())], ["archive", "members"])

        for whole in batches:
            for batch in split(whole, column, 1 << 20):
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for doc_id, text in zip(ids, texts):
                    if out is None:
                        out = opened()
                    png = encode((text or "").encode())
                    info = zipfile.ZipInfo(f"{out[3][0]:08d}_{'null' if doc_id is None else doc_id}.png", (1980, 1, 1, 0, 0, 0))
                    out[2].writestr(info, png)
                    out[3][0] += 1
                    out[3][1] += len(png)
                    if out[3][1] >= ARCHIVE_BYTES:
                        yield closed(out)
                        out = None
        if out is not None:
            yield closed(out)

    return materialize(docs.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias(column)).mapInArrow(run, "archive string, members long"))


# ---- read ----------------------------------------------------------------------------------------------------------


class Range(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


@functools.lru_cache(maxsize=4)
def directory_of(top: str, archive: str) -> list[zipfile.ZipInfo]:
    """Members of an archive, read once a worker for all ranges of the archive that it gets."""
    fs, at = _fs(top)
    with fs.open_input_file(f"{at}/{archive}") as f, zipfile.ZipFile(f) as z:
        return z.infolist()


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.tries = int(options.get("tries", TRIES))
        self.only = options.get("archives")

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs as pafs

        fs, top = _fs(self.path)
        only = set(self.only.split(",")) if self.only else None
        listed = fs.get_file_info(pafs.FileSelector(top, recursive=True))
        found = sorted((f.path.removeprefix(top.rstrip("/")).lstrip("/"), f.size) for f in listed if f.is_file and f.base_name.endswith(".zip"))
        return [Range(name, at, min(at + self.range_bytes, size)) for name, size in found if only is None or name in only for at in range(0, max(1, size), self.range_bytes)] or [Range("", 0, 0)]

    def fetch(self, fs, path: str, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        """One member by its offset, on a stream of its own; again if it fails."""
        why = ""
        for _ in range(self.tries):
            try:
                with fs.open_input_file(path) as f:
                    f.seek(info.header_offset)
                    head = f.read(30)
                    if head[:4] != b"PK\x03\x04":
                        raise OSError("no member starts at this offset")
                    name, extra = struct.unpack_from("<HH", head, 26)
                    f.seek(info.header_offset + 30 + name + extra)
                    data = f.read(info.compress_size)
                    if len(data) == info.compress_size and info.compress_type == zipfile.ZIP_DEFLATED:
                        data = zlib.decompressobj(-15).decompress(data, info.file_size + 1)
                    elif info.compress_type != zipfile.ZIP_STORED:
                        raise OSError(f"compression method {info.compress_type} is not read")
                if len(data) != info.file_size or zlib.crc32(data) != info.CRC:
                    raise OSError("member does not match its checksum")
                return data, None
            except (OSError, zlib.error) as e:
                why = str(e)
        return None, why

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.archive:
            return
        fs, top = _fs(self.path)
        path = f"{top}/{part.archive}"
        names = ["archive", "offset", "member", "content", "error"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        rows, size = [], 0
        for info in directory_of(self.path, part.archive):
            if not part.start <= info.header_offset < part.end or info.is_dir():
                continue
            data, error = self.fetch(fs, path, info)
            rows.append((part.archive, info.header_offset, info.filename, data, error))
            size += len(data or b"")
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class ArchiveMembers(DataSource):
    """``spark.read.format("archive_members").load(directory)``; options rangeBytes, tries, archives (names below the directory,
    comma-separated). Archives in directories below are read, too; members are stored or deflated, others are reported as errors."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)


def members(spark: SparkSession, directory: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveMembers)
    return spark.read.format("archive_members").options(**options).load(directory)


def measure(found: DataFrame) -> DataFrame:
    """Members -> doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, error.

    A member that could not be read keeps its doc_id and has nulls and the error.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, content, error in zip(b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist()):
                label = name.rpartition(".")[0].partition("_")[2]
                doc_id = None if label == "null" else int(label)
                if error is None:
                    data = content.as_py()
                    try:
                        n, payload = decode(data)
                        sha = hashlib.sha256
                        rows.append((doc_id, n, len(payload), sha(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(data), sha(data).hexdigest(), describe(payload), None))
                        continue
                    except (ValueError, zlib.error) as e:
                        error = str(e)
                rows.append((doc_id, *[None] * 7, error))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)

    return found.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string")


def op3_media(spark, sf_dir: str) -> DataFrame:
    """Stores every text and reads it back; one row a document. Null text is empty, an empty text has 64 bytes 0; repeated rows
    are members of their own with equal values; an empty table gives no archive and no row."""
    directory = f"{scratch_dir(spark)}/media-{uuid.uuid4().hex}"
    fs, top = _fs(directory)
    fs.create_dir(top)
    listed = store(spark.read.parquet(f"{sf_dir}/documents.parquet"), directory)
    found = members(spark, directory)
    # only archives of tasks that ended well
    return measure(found.join(listed.select(F.col("archive").alias("_listed")), F.col("archive") == F.col("_listed"), "left_semi").select(*found.columns))
