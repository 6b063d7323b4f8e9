"""Shared machinery of the training-data operators: shared scratch tables, word and hash kernels, salted ranks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..plans.scratch import materialize, release, scratch_dir  # noqa: F401

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def fresh(df: DataFrame, *names: str) -> str | list[str]:
    """Column names like the given ones that df has not, whatever the case of its letters; one name or a list."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out[0] if len(out) == 1 else out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what one Arrow batch of documents can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def n_words(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in text; null and empty count 0."""
    return F.when(text.isNotNull(), F.size(F.array_remove(F.split(text, WORD_GAP), ""))).otherwise(0).cast("long")


def tidy() -> None:
    """Give memory that was freed back to the system: a worker lives on after its task, beside others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """A function of batches for mapInArrow that leaves its worker tidy."""

    @functools.wraps(run)
    def leaner(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return leaner


def lean_group(run):
    """A function of a group's table for applyInArrow that leaves its worker tidy."""

    @functools.wraps(run)
    def leaner(table):
        out = run(table)
        tidy()
        return out

    return leaner


#: Rows of one group that one task numbers.
RANK_ROWS = 50_000


def salts_for(largest: int) -> int:
    """Salts for groups of up to that many rows."""
    return max(16, -(-largest // RANK_ROWS))


def salted_rank(df: DataFrame, keys: list[str], order: list[Column], salt_on: Column, rank: str, salts: int, groups: DataFrame | None = None, narrow: DataFrame | None = None) -> DataFrame:
    """A gapless rank from 0 within keys, without one task per key: rows are dealt to salts, counted, and numbered within (keys, salt).

    The order between salts is that of the salt; ties beyond ``order`` are interchangeable only if the caller makes
    them so. Rows with null keys form one group. ``groups`` (keys..., more columns) adds its columns to each row of df
    on the way; rows without a group there are dropped. ``narrow`` has the same rows in fewer columns, for the counts.
    """
    salt, n, start, *other = fresh(df, "salt", "n", "start", "s", *[f"k{i}" for i in range(len(keys))])
    number = F.pmod(salt_on, F.lit(salts)).cast("int")
    salted = df.withColumn(salt, number)
    counts = (narrow if narrow is not None else df).withColumn(salt, number).groupBy(*keys, salt).agg(F.count(F.lit(1)).alias(n))
    upto = W.partitionBy(*keys).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn(start, F.coalesce(F.sum(n).over(upto), F.lit(0))).drop(n)
    same = lambda a, b: functools.reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)])
    starts = starts.select(start, F.col(salt).alias(other[0]), *[F.col(k).alias(o) for k, o in zip(keys, other[1:])])
    if groups is not None:
        renamed = [f"_g{o}" for o in other[1:]]
        starts = starts.join(groups.withColumnsRenamed(dict(zip(keys, renamed))), same(other[1:], renamed)).drop(*renamed)
    within = W.partitionBy(*keys, salt).orderBy(*order)
    joined = salted.join(starts, same([*keys, salt], [*other[1:], other[0]]))
    return joined.withColumn(rank, (F.col(start) + F.row_number().over(within) - 1).cast("long")).drop(salt, start, *other)


# ---- numpy kernels -------------------------------------------------------------------------------------------------

_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
IS_GAP = np.zeros(256, dtype=bool)
IS_GAP[[9, 10, 11, 12, 13, 32]] = True
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; base is odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size, out = -(-int(n) >> 16) << 16, []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        have = _powers[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits (splitmix64's finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(codes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of codes[i] * base**i, with a leading 0."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(base, len(codes) + 1)[0][: len(codes)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of codes[start:end], equal for equal contents anywhere."""
    return mix((prefix[end] - prefix[start]) * powers(base, len(prefix))[1][start] + (end - start).astype(np.uint64))


#: Items hashed at once, so that a very long text takes no more memory than many short ones; longest word that is.
HASH_STEP, LONG_WORD = 1 << 18, 1 << 16


class Words:
    """Words of documents that lie one after another in a byte buffer: starts, ends, owning document, 64-bit hash."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False, gap: np.ndarray = IS_GAP):
        n = len(buf)
        word = np.zeros(n + 2, dtype=bool)
        word[1:-1] = ~gap[buf]
        edge = np.zeros(n + 2, dtype=bool)
        edge[offsets + 1] = True  # a document starts (or all end) here
        self.start = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[1:-1]))
        self.end = np.flatnonzero(word[1:-1] & (~word[2:] | edge[2:])) + 1
        bound = np.searchsorted(self.start, offsets)
        self.first, self.count = bound[:-1], np.diff(bound)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.buf, self.lower = buf, lower
        self.hash = self.hashes(BASES[0])

    def hashes(self, base: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes, independent of that by another base."""
        out = np.empty(len(self.start), np.uint64)
        size = self.end - self.start
        for low in np.unique(self.start // HASH_STEP).tolist():
            a, b = np.searchsorted(self.start, [low * HASH_STEP, (low + 1) * HASH_STEP])
            mine = np.arange(a, b)[size[a:b] <= LONG_WORD]
            if len(mine):
                at = self.start[mine[0]]
                codes = BYTE_CODES[self._plain(at, self.end[mine].max())]
                out[mine] = span_hash(prefix_hash(codes, base), self.start[mine] - at, self.end[mine] - at, base)
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            data = self._plain(self.start[i], self.end[i]).tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=(base % 2**32).to_bytes(8, "little")).digest(), "little")
        return out

    def _plain(self, low: int, high: int) -> np.ndarray:
        part = self.buf[low:high]
        return part + ((part >= 65) & (part <= 90)).astype(np.uint8) * np.uint8(32) if self.lower else part

    def windows(self, size: int, at: np.ndarray | None = None, base: int = BASES[1], of: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the windows of size words that start at the given words, in order (default: all that fit the buffer)."""
        if at is None:
            at = np.arange(max(0, len(self.hash) - size + 1))
        of = self.hash if of is None else of
        out = np.empty(len(at), np.uint64)
        for low in np.unique(at // HASH_STEP).tolist():
            a, b = np.searchsorted(at, [low * HASH_STEP, (low + 1) * HASH_STEP])
            mine = at[a:b] - at[a]
            out[a:b] = span_hash(prefix_hash(of[at[a] : at[b - 1] + size], base), mine, mine + size, base)
        return out

    def fits(self, size: int) -> np.ndarray:
        """Which words start a window of size words within their document."""
        place = np.arange(len(self.start)) - self.first[self.doc]
        return place + size <= self.count[self.doc]


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n items lie in [s, s + size) for any start s."""
    return np.cumsum(np.bincount(starts, minlength=n + 1)[:n] - np.bincount(np.minimum(starts + size, n), minlength=n + 1)[:n]) > 0
