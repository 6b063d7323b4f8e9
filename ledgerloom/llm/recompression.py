"""Substring dedup by recompression.

Every document's word sequence is shortened in rounds that look only at neighbours: a run of one symbol becomes a
symbol, then pairs (a, b) with a in one half of the alphabet and b in the other. The name of a new symbol is the hash
of what it stands for, so all executors give equal substrings the same interior symbols without a lookup. After the
rounds, one exchange finds the top symbols that occur in two places of the corpus.

Each symbol also knows its reach: the stretch of words that settled it. A pair needs no neighbours; a symbol left alone
depends on the one beside it. Two copies of a window share every symbol whose reach lies in it, so a window with a
symbol of that kind that occurs once is no repeat. The rest are verified by a second exchange, of 128-bit fingerprints
of their words (two of 64 bits, each over word hashes of its own). No repeat is missed whatever the rounds do; they decide how few other windows are left to verify.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import SENT, answers, hashed, n_buckets, replies_of, seen_twice, send, settle, texts, to_blocks, unpack
from .common import BASES, Words, covered, lean, materialize, mix

WINDOW = 35
PAIRS = 3
FAR = 1 << 40
SYMBOL = np.dtype([("key", "<u8"), ("many", "u1")])
FINGER = np.dtype([("key", "<u8"), ("more", "<u8"), ("many", "u1")])


def compress(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Top symbols of all documents: names, and their reach (first word and word after the last)."""
    name, doc = words.hash, words.doc
    n = len(name)
    if not n:
        return name, words.first[:0], words.first[:0]
    # run step: k equal words become one symbol (word, k); one word on either side tells where the run ends
    new = np.ones(n, bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    k = np.diff(np.append(first, n))
    name, doc = np.where(k > 1, mix(name[first] + mix(k.astype(np.uint64))), name[first]), doc[first]
    low, high = first - 1, first + k + 1
    for step in range(PAIRS):
        left = (mix(name ^ np.uint64(0xC0FFEE + step)) >> np.uint64(63)).astype(bool)
        joined = np.flatnonzero(left[:-1] & ~left[1:] & (doc[:-1] == doc[1:]))
        alone = np.ones(len(name), bool)
        alone[joined] = alone[joined + 1] = False
        to_right, to_left = np.flatnonzero(alone & left), np.flatnonzero(alone & ~left)
        reach_low, reach_high = low.copy(), high.copy()
        # beyond a document's edge lies what no window of it can hold
        last = np.append(doc[1:] != doc[:-1], True)
        head = np.append(True, doc[1:] != doc[:-1])
        at = to_right[~last[to_right]]
        reach_high[at], reach_low[at] = np.maximum(high[at], high[at + 1]), np.minimum(low[at], low[at + 1])
        reach_high[to_right[last[to_right]]] = n + FAR
        at = to_left[~head[to_left]]
        reach_high[at], reach_low[at] = np.maximum(high[at], high[at - 1]), np.minimum(low[at], low[at - 1])
        reach_low[to_left[head[to_left]]] = -FAR
        reach_low[joined], reach_high[joined] = np.minimum(low[joined], low[joined + 1]), np.maximum(high[joined], high[joined + 1])
        name = name.copy()
        name[joined] = mix(mix(name[joined]) * np.uint64(3) + name[joined + 1] + np.uint64(step))
        stay = np.ones(len(name), bool)
        stay[joined + 1] = False
        name, low, high, doc = name[stay], reach_low[stay], reach_high[stay], doc[stay]
    return name, low, high


def _words(data: bytes, column: str) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, Words]:
    batch = unpack(data)
    buf, offsets = texts(batch, column)
    return batch, buf, offsets, Words(buf, offsets)


def _candidates(words: Words, low: np.ndarray, high: np.ndarray, shared: np.ndarray, size: int) -> np.ndarray:
    """Window starts whose window holds no symbol's reach whose symbol occurs once."""
    n = len(words.start)
    marks = np.zeros(n + 1, np.int32)
    first, last = np.maximum(high[~shared] - size, 0), np.minimum(low[~shared], n - 1)
    ok = first <= last
    np.add.at(marks, first[ok], 1)
    np.add.at(marks, last[ok] + 1, -1)
    return np.flatnonzero((np.cumsum(marks[:-1]) == 0) & words.fits(size))


def _fingers(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of windows in a block, and which each window has."""
    key = np.empty(len(at), FINGER)
    key["key"], key["more"] = words.windows(size, at), words.windows(size, at, BASES[0], words.hashes(BASES[1]) if len(at) else None)
    order = np.lexsort((key["more"], key["key"]))
    s = key[order]
    new = np.ones(len(s), bool)
    new[1:] = (s["key"][1:] != s["key"][:-1]) | (s["more"][1:] != s["more"][:-1])
    which = np.empty(len(s), np.int64)
    which[order] = np.cumsum(new) - 1
    out = s[new]
    out["many"] = np.bincount(which, minlength=len(out)) > 1
    return out, which


def _same_fingers(parts: list[np.ndarray]) -> list[np.ndarray]:
    rows = np.concatenate(parts)
    order = np.lexsort((rows["more"], rows["key"]))
    s = rows[order]
    eq = (s["key"][1:] == s["key"][:-1]) & (s["more"][1:] == s["more"][:-1])
    same = np.zeros(len(s), bool)
    same[1:] |= eq
    same[:-1] |= eq
    out = np.empty(len(s), bool)
    out[order] = same
    return np.split(out | (rows["many"] != 0), np.cumsum([len(p) for p in parts])[:-1])


def repeated_words(docs: DataFrame, column: str = "text", size: int = WINDOW):
    """Blocks of docs with the replies of both exchanges, and a function for workers that gives, for such a row,
    (batch, words, covered): its documents, their words and which of them lie in a repeated window."""
    blocks = to_blocks(docs, column)
    buckets = n_buckets(blocks)

    def symbols(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        name, low, high = compress(words)
        keys, which, times = np.unique(name, return_inverse=True, return_counts=True)
        rows = np.empty(len(keys), SYMBOL)
        rows["key"], rows["many"] = keys, times > 1
        return keys, which, rows, low, high

    @lean
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1)):
                keys, _, rows, _, _ = symbols(_words(data.as_py(), column)[3])
                yield from send(block, hashed(keys, buckets), rows, buckets)

    def windows(words: Words, got: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, which, _, low, high = symbols(words)
        at = _candidates(words, low, high, answers(hashed(keys, buckets), buckets, got)[which], size)
        rows, which = _fingers(words, at, size)
        return at, rows, which

    @lean
    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column(0).to_pylist()):
                _, rows, _ = windows(_words(b.column(1)[i].as_py(), column)[3], replies_of(b, i, "names"))
                yield from send(block, hashed(rows["key"], buckets), rows, buckets)

    def found(b: pa.RecordBatch, i: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, Words, np.ndarray]:
        batch, buf, offsets, words = _words(b.column(b.schema.get_field_index("data"))[i].as_py(), column)
        at, rows, which = windows(words, replies_of(b, i, "names"))
        bits = answers(hashed(rows["key"], buckets), buckets, replies_of(b, i, "fingers"))[which]
        return batch, buf, offsets, words, covered(at[bits], size, len(words.start))

    names = materialize(settle(blocks.select("block", "data").mapInArrow(first, SENT), seen_twice, SYMBOL).withColumnRenamed("replies", "names"))
    with_names = blocks.join(names, "block", "left").select("block", "data", "names")
    fingers = materialize(settle(with_names.mapInArrow(second, SENT), _same_fingers, FINGER).withColumnRenamed("replies", "fingers"))
    return with_names.join(fingers, "block", "left").select("data", "names", "fingers"), found


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row: words in windows that also start elsewhere are removed.

    A repeated row is elsewhere, too. Null text has no words; documents shorter than the window lose nothing.
    """
    rows, found = repeated_words(docs.select("doc_id", "text"), size=size)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                batch, buf, _, words, gone = found(b, i)
                removed = np.bincount(words.doc[gone], minlength=len(words.count))
                raw, sha = buf.tobytes(), []
                for f, n, m in zip(words.first.tolist(), words.count.tolist(), removed.tolist()):
                    if m < n:
                        kept = np.flatnonzero(~gone[f : f + n]) + f if m else range(f, f + n)
                        sha.append(hashlib.sha256(b" ".join([raw[s:e] for s, e in zip(words.start[kept].tolist(), words.end[kept].tolist())])).hexdigest())
                    else:
                        sha.append(hashlib.sha256(b"").hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.count), pa.array(removed), pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, for windows of 35 words. See remove_repeats for nulls, short texts and
    repeated rows; an empty table gives an empty result."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, unnest(range(1, len(ws) + 1)) AS k, len(ws) AS n, ws FROM d),
s AS (SELECT r, k, CASE WHEN k + 34 <= n THEN md5(array_to_string(ws[k:k + 34], ' ')) END AS h, ws[k] AS word FROM w),
c AS (SELECT h FROM s WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
g AS (SELECT s.r, s.k, s.word, max(CASE WHEN c.h IS NOT NULL THEN s.k END) OVER (PARTITION BY s.r ORDER BY s.k ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM s LEFT JOIN c ON s.h = c.h),
a AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY k) FILTER (WHERE NOT gone), '') AS kept FROM g GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (r)
"""
