"""Blocked corpus and packed exchange.

A block is one row that holds about ``block_bytes`` of whole documents as a compressed Arrow batch. Operators that must
compare every position of every text send keys from blocks to hash buckets as packed arrays (a row a block and bucket,
not a row a key), settle them in the bucket, and get one bit a key back in the order sent. The JVM moves few, large
rows; a task holds one block or one bucket. In a block equal keys are sent once, so that a key that fills a third of
the corpus reaches its bucket once a block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import lean, lean_group, materialize, small_batches

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 12 << 20


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as src:
        return src.read_next_batch()


def texts(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each starts; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    col = pc.fill_null(col, "").cast(pa.large_string()) if col.type != pa.null() else pa.array([""] * len(col), pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset :]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def split(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows of about size bytes of text each; a longer text stands alone."""
    off = texts(batch, column)[1]
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def to_blocks(docs: DataFrame, column: str = "text", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Table (block, bytes, data): every row of docs, all columns, in exactly one block."""
    small_batches(docs.sparkSession)

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, have, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq, have, size
            one = pa.Table.from_batches(have).combine_chunks().to_batches()[0]
            row = pa.RecordBatch.from_arrays([pa.array([(part << 32) | seq], pa.int64()), pa.array([size], pa.int64()), pa.array([_pack(one)], pa.binary())], ["block", "bytes", "data"])
            seq, have, size = seq + 1, [], 0
            return row

        for batch in batches:
            for piece in split(batch, column, block_bytes):
                n = int(texts(piece, column)[1][-1])
                if have and size + n > block_bytes:
                    yield flush()
                have.append(piece)
                size += n
        if have:
            yield flush()

    return materialize(docs.mapInArrow(pack, "block long, bytes long, data binary"), keep)


def n_buckets(blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    return max(1, math.ceil(total / bucket_bytes))


SENT = "bucket int, block long, data binary"


def dealt(to: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of items by bucket, and where each bucket starts in it."""
    order = np.argsort(to, kind="stable")
    return order, np.searchsorted(to[order], np.arange(buckets + 1))


def send(block: int, to: np.ndarray, rows: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange: ``rows`` (a structured or plain array) dealt to the buckets ``to``, in order within a bucket."""
    if len(to):
        order, ends = dealt(to, buckets)
        used = np.flatnonzero(np.diff(ends))
        sorted_rows = rows[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), block, np.int64)), pa.array([sorted_rows[ends[b] : ends[b + 1]].tobytes() for b in used], pa.binary())],
            ["bucket", "block", "data"],
        )


def hashed(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of 64-bit keys."""
    return (keys % np.uint64(buckets)).astype(np.int64)


def answers(to: np.ndarray, buckets: int, got: list[tuple[int, bytes]], width: int = 1) -> np.ndarray:
    """The bits of each item (width a row), from the replies (bucket, packed bits) of its block."""
    out = np.zeros((len(to), width), dtype=bool)
    order, ends = dealt(to, buckets)
    for b, bits in got:
        n = int(ends[b + 1] - ends[b])
        out[order[ends[b] : ends[b + 1]]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n * width).reshape(n, width)
    return out[:, 0] if width == 1 else out


def settle(sent: DataFrame, decide: Callable[[list[np.ndarray]], list[np.ndarray]], dtype: np.dtype) -> DataFrame:
    """In each bucket, decide a bit for each key of each block; back to (block, replies)."""

    @lean_group
    def bucket(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), dtype=dtype) for x in table["data"]]
        bits = decide(parts)
        return pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())})

    out = sent.groupBy("bucket").applyInArrow(bucket, "block long, bucket int, bits binary")
    return out.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("replies"))


def replies_of(batch: pa.RecordBatch, i: int, name: str) -> list[tuple[int, bytes]]:
    got = batch.column(batch.schema.get_field_index(name))[i].as_py() or []
    return [(x["bucket"], x["bits"]) for x in got]


def seen_twice(parts: list[np.ndarray]) -> list[np.ndarray]:
    """For packed (key, many) rows: does the key occur in two places of the corpus?"""
    keys = np.concatenate([p["key"] for p in parts])
    many = np.concatenate([p["many"] for p in parts])
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), dtype=bool)
    if len(s):
        eq = s[1:] == s[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    out = np.empty(len(s), dtype=bool)
    out[order] = same
    out |= many != 0
    return np.split(out, np.cumsum([len(p) for p in parts])[:-1])
