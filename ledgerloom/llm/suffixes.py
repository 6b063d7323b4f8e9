"""Suffix-array dedup by blockwise sorting with a difference cover.

Suffixes are dealt to buckets by lexicographic range, and one bucket is sorted at a time. Of the suffixes in any ``size``
bytes one is chosen that the bytes themselves tell (the one whose first K bytes have the smallest hash, the anchor);
its lexicographic range gives the bucket, so equal strings of that length meet in one bucket with equal offsets to the
anchor, and neighbouring suffixes share one row of text. The ranges come from a sample of suffixes, which decides how
even the buckets are and nothing else. Anchors that occur once in the corpus are left out by an exchange of keys first:
nothing that starts there repeats.

In a bucket rows are sorted by anchor and taken some tens of thousands at a time, laid side by side with anchors in one
column. Columns whose number mod V is in the difference cover D are the cover sample: their ranks to depth 2**k * V are
computed by doubling, once for the rows at hand. Any suffix is then sorted by at most 3 first bytes and the rank of the
sample that follows; long ties cost no more than short ones, and memory is that of the rows at hand. Neighbours in suffix
order that share ``size`` bytes are one string; the smallest document of each tells which suffixes are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import SENT, answers, hashed, n_buckets, replies_of, seen_twice, send, settle, texts, to_blocks, unpack
from .common import BASES, BYTE_CODES, covered, fresh, lean, materialize, mix, powers, prefix_hash, span_hash

SIZE = 50
K = 16
V, D = 7, (1, 2, 4)
#: Bytes from a column to the next column of the cover sample.
TO_SAMPLE = [min((d - c) % V for d in D) for c in range(V)]
ANCHOR = np.dtype([("key", "<u8"), ("many", "u1")])
NO_ID = np.iinfo(np.int64).max
#: Window starts that are looked at at once, so a very long text takes no more memory than many short ones.
STEP = 1 << 18
#: Rows of a bucket that are sorted at once; columns of windows that a larger group of one anchor is split by.
ROWS, COLUMNS = 30_000, 5
#: Blocks, and suffixes of each, that the ranges of buckets are drawn from.
SAMPLE_BLOCKS, SAMPLE_SUFFIXES = 16, 4096


class Anchors:
    """Anchors of all windows of size bytes in a buffer of documents: runs of window starts, their anchor and, if asked, two prints of their text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, size: int, prints: bool = True):
        n, w, found = len(buf), size - K + 1, []
        for low in range(0, n - size + 1, STEP):
            part = buf[low : min(n, low + STEP + size - 1)]
            codes = BYTE_CODES[part]
            prefix = prefix_hash(codes, BASES[0])
            at = np.arange(len(part) - K + 1)
            gram = mix((prefix[K:] - prefix[:-K]) * powers(BASES[0], len(part) + 1)[1][: len(at)])
            least = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)  # the leftmost of equal ones wins
            span = 1
            while span < w:  # least of w neighbours by doubling
                step = min(span, w - span)
                least = np.minimum(least[: len(least) - step], least[step:])
                span += step
            pos = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            held = np.diff(np.clip(offsets, low, low + len(pos)))
            last = np.repeat(np.clip(offsets[1:] - size - low, -1, len(pos)).astype(np.int32), held)  # the last window of each one's document
            ok = np.arange(len(pos), dtype=np.int32) <= last
            new = np.zeros(len(pos), bool)
            new[0] = True
            new[1:] = (pos[1:] != pos[:-1]) | (ok[1:] & ~ok[:-1])
            heads = np.unique(np.cumsum(held) - held)
            new[heads[heads < len(pos)]] = True
            starts = np.flatnonzero(new & ok)
            change = np.append(np.flatnonzero(new | ~ok), len(pos))
            ends = change[np.searchsorted(change, starts, side="right")]
            first = second = np.zeros(0, np.uint64)
            if prints:
                first = span_hash(prefix, starts, ends - 1 + size, BASES[0])
                second = span_hash(prefix_hash(codes, BASES[1]), starts, ends - 1 + size, BASES[1])
            doc = np.searchsorted(offsets, low + starts, side="right") - 1
            found.append((low + starts, low + ends - 1, low + pos[starts], doc, mix(gram[pos[starts]] + np.uint64(0x5EED)), first, second))
        if not found:
            found = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64))]
        self.first, self.last, self.at, self.doc, self.key, self.print, self.second = (np.concatenate(x) for x in zip(*found))


def _read(data: bytes, column: str, size: int, prints: bool = True) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, Anchors]:
    batch = unpack(data)
    buf, offsets = texts(batch, column)
    return batch, buf, offsets, Anchors(buf, offsets, size, prints)


def _lead(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first 8 bytes of suffixes, as numbers in lexicographic order."""
    out = np.zeros(len(at), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | buf[at + i]
    return out


class Contexts:
    """Distinct texts around the shared anchors of a block: ``use`` are the anchors' numbers, ``which`` their context, ``doc``
    their documents; ``one`` has an anchor of each context, ``least`` its smallest document."""

    def __init__(self, a: Anchors, shared: np.ndarray, ids: np.ndarray):
        self.use = np.flatnonzero(shared)
        self.doc = ids[a.doc[self.use]] if len(self.use) else np.zeros(0, np.int64)
        first = a.print[self.use] ^ mix((a.at - a.first)[self.use].astype(np.uint64))  # with where the anchor is
        second = a.second[self.use]
        order = np.lexsort((self.doc, second, first))
        new = np.ones(len(order), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.one, self.least = self.use[order[new]], self.doc[order[new]]


def row_type(size: int) -> np.dtype:
    return np.dtype([("before", "u1"), ("windows", "u1"), ("doc", "<i8"), ("text", "u1", (2 * size - K,))])


def _rows(buf: np.ndarray, a: Anchors, c: Contexts, size: int) -> np.ndarray:
    """Rows for the exchange: offset of the anchor, windows, smallest doc, text."""
    rows = np.zeros(len(c.one), row_type(size))
    first, count = a.first[c.one], a.last[c.one] - a.first[c.one] + 1
    rows["before"], rows["windows"], rows["doc"] = a.at[c.one] - first, count, c.least
    width = rows["text"].shape[1]
    cols, texts_at = np.arange(width), np.lib.stride_tricks.sliding_window_view(np.append(buf, np.zeros(width, np.uint8)), width)
    for at in range(0, len(rows), 1 << 15):
        f, n = first[at : at + (1 << 15)], count[at : at + (1 << 15)]
        rows["text"][at : at + (1 << 15)] = texts_at[f] * (cols < (n + size - 1)[:, None])
    return rows


def sort_bucket(text: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, size: int, cols: range) -> np.ndarray:
    """For each row and window column of ``cols``, does its string of ``size`` bytes also start in a row with a smaller doc?

    text: rows x columns, anchors in one column; low, high: the windows each row has.
    """
    n, width = text.shape
    depth = V
    while depth < size:
        depth *= 2
    padded = np.zeros((n, width + 2 * depth), np.uint8)
    padded[:, :width] = text
    needed = sorted({c + TO_SAMPLE[c % V] for c in cols})

    def number(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        s = key[order]
        out = np.empty(n, np.uint64)
        out[order] = np.cumsum(np.append(False, s[1:] != s[:-1]), dtype=np.uint64) if n else s
        return out

    def bytes_at(c: int, k: int) -> np.ndarray:
        if not k:
            return np.zeros(n, np.uint64)
        return np.ndarray(n, ">u8", buffer=padded, offset=c, strides=(padded.shape[1],)).astype(np.uint64) >> np.uint64(64 - 8 * k)

    # ranks of the cover sample by doubling; depth V first
    ranks = {c: number(bytes_at(c, V)) for c in {c + k * V for c in needed for k in range(depth // V)}}
    d = V
    while d < depth:
        keep = {c + k * 2 * d for c in needed for k in range(depth // (2 * d))} if 2 * d < depth else set(needed)
        ranks = {c: number((ranks[c] << np.uint64(32)) | ranks[c + d]) for c in keep}
        d *= 2
    out = np.zeros((n, len(cols)), bool)
    eights = size // 8
    for j, c in enumerate(cols):
        rows = np.flatnonzero((low <= c) & (c <= high))
        if len(rows) < 2:
            continue
        skip = TO_SAMPLE[c % V]
        key = (bytes_at(c, skip) << np.uint64(40)) | ranks[c + skip]  # ranks are below 2**32
        rows = rows[np.argsort(key[rows])]
        wide = np.ndarray((n, eights), "<u8", buffer=padded, offset=c, strides=(padded.shape[1], 8))[rows]
        tail = padded[rows, c + 8 * eights : c + size]
        same = (wide[1:] == wide[:-1]).all(1) & (tail[1:] == tail[:-1]).all(1)
        start = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(doc[rows], start)
        out[rows, j] = np.repeat(least, np.diff(np.append(start, len(rows)))) < doc[rows]
    return out


def _lots(key: np.ndarray, second: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Rows in order of (key, second), whole groups of equal ones, about ``most`` at a time; true for one group larger than that. Groups of one row are left out."""
    order = np.lexsort((second, key))
    new = np.append(True, (key[order][1:] != key[order][:-1]) | (second[order][1:] != second[order][:-1])) if len(key) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(key)))
    several = np.repeat(size > 1, size)
    order, size = order[several], size[size > 1]
    ends, at = np.append(0, np.cumsum(size)), 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield order[ends[at] : ends[upto]], bool(size[at] > most)
        at = upto


def _repeats(parts: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Bits for each window of each row, rows in the order sent."""
    rows = np.concatenate(parts)
    w = size - K + 1
    n, width = len(rows), 2 * size - K
    out = np.zeros((n, w), bool)
    anchor = np.take_along_axis(rows["text"], rows["before"].astype(np.int64)[:, None] + np.arange(K), axis=1).view(">u8") if n else np.zeros((0, 2), np.uint64)
    cells = np.arange(width)
    for take, large in _lots(anchor[:, 0], anchor[:, 1], ROWS):
        r = rows[take]
        # anchors to one column: windows of a row end up at w - 1 - before + i
        shift = (w - 1 - r["before"]).astype(np.int64)
        text = np.zeros((len(take), width + w), np.uint8)
        np.put_along_axis(text, shift[:, None] + cells, r["text"], axis=1)
        text, low, high = text[:, :width], shift, shift + r["windows"] - 1
        hit = np.zeros((len(take), 2 * w), bool)
        if not large:
            hit[:, :w] = sort_bucket(text, low, high, r["doc"], size, range(w))
        else:  # windows of a few columns share all bytes but the outermost, which split the group further
            for c in range(0, w, COLUMNS):
                cols = range(c, min(w, c + COLUMNS))
                codes = BYTE_CODES[text[:, cols[-1] : c + size]]
                prints = [mix((codes * powers(b, size)[0][: codes.shape[1]]).sum(1, dtype=np.uint64)) for b in BASES]
                active = np.flatnonzero((low <= cols[-1]) & (high >= c))
                for some, _ in _lots(prints[0][active], prints[1][active], ROWS):
                    some = active[some]
                    hit[some[:, None], np.array(cols)] = sort_bucket(text[some], low[some], high[some], r["doc"][some], size, cols)
        out[take] = np.take_along_axis(hit, shift[:, None] + np.arange(w), axis=1)
    return np.split(out, np.cumsum([len(p) for p in parts])[:-1])


def repeated_bytes(docs: DataFrame, order_id: str, column: str = "text", size: int = SIZE):
    """Blocks of docs with the replies of both exchanges, and a function for workers that gives, for such a row,
    (batch, buf, offsets, gone): which bytes lie in a string of size bytes that also starts in a document with a
    smaller ``order_id`` (a long column; null is larger than any)."""
    blocks = to_blocks(docs, column, block_bytes=1 << 20)  # a worker holds some hundred bytes a byte of text
    buckets = n_buckets(blocks)
    ranges = 3 * buckets  # rows are several times their text
    w = size - K + 1

    def anchors(a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, which, times = np.unique(a.key, return_inverse=True, return_counts=True)
        rows = np.empty(len(keys), ANCHOR)
        rows["key"], rows["many"] = keys, times > 1
        return keys, which, rows

    @lean
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1)):
                keys, _, rows = anchors(_read(data.as_py(), column, size, False)[3])
                yield from send(block, hashed(keys, buckets), rows, buckets)

    def around(b: pa.RecordBatch, i: int):
        batch, buf, offsets, a = _read(b.column(b.schema.get_field_index("data"))[i].as_py(), column, size)
        keys, which, _ = anchors(a)
        shared = answers(hashed(keys, buckets), buckets, replies_of(b, i, "anchors"))[which]
        ids = batch.column(batch.schema.get_field_index(order_id))
        ids = np.array([NO_ID if x is None else x for x in ids.to_pylist()], dtype=np.int64)
        return batch, buf, offsets, a, Contexts(a, shared, ids)

    @lean
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                _, buf, _, a, c = around(b, i)
                leads = np.sort(_lead(buf, a.at[c.one]))[:: 1 + len(c.one) // SAMPLE_SUFFIXES]
                yield pa.RecordBatch.from_arrays([pa.array([leads.tobytes()], pa.binary())], ["leads"])

    names = materialize(settle(blocks.select("block", "data").mapInArrow(first, SENT), seen_twice, ANCHOR).withColumnRenamed("replies", "anchors"))
    with_names = blocks.join(names, "block", "left").select("block", "data", "anchors")
    splits = np.zeros(0, np.uint64)
    if ranges > 1:
        few = F.pmod(F.xxhash64("block"), F.lit(max(1, blocks.count() // SAMPLE_BLOCKS))) == 0
        leads = np.sort(np.concatenate([splits, *[np.frombuffer(x.leads, np.uint64) for x in with_names.filter(few).mapInArrow(sample, "leads binary").collect()]]))
        splits = leads[np.arange(1, ranges) * len(leads) // ranges] if len(leads) else leads

    def bucket_of(buf: np.ndarray, a: Anchors, c: Contexts) -> np.ndarray:
        return np.searchsorted(splits, _lead(buf, a.at[c.one]), side="right")

    @lean
    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column(0).to_pylist()):
                _, buf, _, a, c = around(b, i)
                yield from send(block, bucket_of(buf, a, c), _rows(buf, a, c, size), ranges)

    def found(b: pa.RecordBatch, i: int):
        batch, buf, offsets, a, c = around(b, i)
        hits = answers(bucket_of(buf, a, c), ranges, replies_of(b, i, "windows"), w)
        mine = hits[c.which] | (c.doc > c.least[c.which])[:, None]
        mine &= np.arange(w) < (a.last[c.use] - a.first[c.use] + 1)[:, None]
        starts = (a.first[c.use][:, None] + np.arange(w))[mine]
        return batch, buf, offsets, covered(starts, size, len(buf))

    hits = materialize(settle(with_names.mapInArrow(second, SENT), lambda parts: _repeats(parts, size), row_type(size)).withColumnRenamed("replies", "windows"))
    return with_names.join(hits, "block", "left").select("data", "anchors", "windows"), found


def spans(gone: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true items within documents: starts and ends."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[offsets] = True
    before = np.append(False, gone[:-1])
    after = np.append(gone[1:], False)
    return np.flatnonzero(gone & (~before | edge[:-1])), np.flatnonzero(gone & (~after | edge[1:])) + 1


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null text is empty. Rows with one doc_id do not remove from each other, as neither is smaller; a null doc_id is
    larger than any.
    """
    rows, found = repeated_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", size=size)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                batch, buf, offsets, gone = found(b, i)
                n = len(offsets) - 1
                total = np.append(0, np.cumsum(gone))
                removed = total[offsets[1:]] - total[offsets[:-1]]
                runs = np.bincount(np.searchsorted(offsets, spans(gone, offsets)[0], side="right") - 1, minlength=n)
                sha = [hashlib.sha256(buf[s:e][~gone[s:e]].tobytes()).hexdigest() for s, e in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, for strings of 50 bytes. See remove_repeats for nulls and
    repeated ids; shorter texts lose nothing; an empty table gives an empty result."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def suffix_stage(spark, docs: DataFrame, sf_dir: str, size: int = SIZE) -> DataFrame:
    """Pipeline stage: texts without repeated strings, n_chars to match, other columns and all rows as they were.

    A character goes if all its bytes go, so texts stay valid; null text stays null.
    """
    order = fresh(docs, "order_id")
    rows, found = repeated_bytes(docs.withColumn(order, F.col("doc_id").cast("long")), order, size=size)
    names = docs.columns

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                batch, buf, offsets, gone = found(b, i)
                lead = np.flatnonzero((buf & 0xC0) != 0x80)
                stays = np.zeros(len(buf), bool)
                if len(buf):
                    keep = np.add.reduceat(~gone, lead) > 0
                    stays = np.repeat(keep, np.diff(np.append(lead, len(buf))))
                was = batch.column(batch.schema.get_field_index("text"))
                out = [None if null else buf[s:e][stays[s:e]].tobytes().decode() for null, s, e in zip(was.is_null().to_pylist(), offsets[:-1], offsets[1:])]
                cols = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
                cols["text"] = pa.array(out, pa.string())
                if "n_chars" in cols:
                    kind = cols["n_chars"].type
                    cols["n_chars"] = pa.array([None if t is None else len(t) for t in out], pa.int64()).cast(kind)
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return rows.mapInArrow(run, docs.schema)
