"""Packing documents into fixed-length training sequences: shortest-pack-first over the length histogram.

Documents are tokenized, cut into pieces, and only the histogram of piece lengths (at most max_len rows) reaches the
driver. There, lengths are placed longest first, each into the pattern with the most room, which updates counts of
patterns, not sequences. A piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .blocks import split
from .common import lean, materialize, salted_rank, salts_for, small_batches

MAX_LEN = 2048
#: Entries of a worker's cache of encoded words; it is emptied when full.
CACHE_ENTRIES = 300_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _bytes_of_symbols() -> dict[str, int]:
    """The symbol that byte-level BPE writes for each byte: printable ones for themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE tokenizer file as little-endian unsigned 32-bit bytes.

    A space before a visible character always starts a new word of this tokenizer, so texts are cut there and each
    distinct piece is encoded once. Texts with other gaps, or with a special token's string, are encoded as a whole.
    """

    _loaded: dict[str, Encoder] = {}

    @classmethod
    def get(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        symbols = _bytes_of_symbols()
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special and all(c in symbols for c in t)}
        words = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("own", pat_str=words, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for t, i in ranks.items():
            self.size[i] = len(t)
        self.cache: dict[str, bytes | None] = {}

    def one(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        cache = self.cache
        new = [p for p in pieces if p not in cache]
        good = [p for p in new if p and not p[0].isspace() and "<|" not in p]
        if len(good) < len(new):
            cache.update(dict.fromkeys(set(new).difference(good)))
        if not good:
            return
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(good)), dtype="<u4")
        ends = np.cumsum([len(p.encode()) + 1 for p in good])
        at = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
        data, a = ids.tobytes(), 0
        for p, b in zip(good, (at * 4).tolist()):
            cache[p] = data[a:b]
            a = b

    def batch(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        parted, pieces = [t.split(" ") for t in texts], set()
        for ps in parted:
            pieces.update(ps[1:])
        self._learn(pieces)
        get, out = self.cache.get, []
        for t, ps in zip(texts, parted):
            got = list(map(get, ps[1:]))
            out.append(self.one(t) if None in got else self.one(ps[0]) + b"".join(got))
        return out


def cuts(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full sequences, then at most one half sequence and one shorter rest."""
    out = [(s, max_len) for s in range(0, n - max_len + 1, max_len)]
    start, half = len(out) * max_len, max_len // 2
    if n - start > half:
        out.append((start, half))
        start += half
    return out + [(start, n - start)] if n > start else out


def tokenize(docs: DataFrame, path: str, max_len: int = MAX_LEN, end_id: int = 1) -> DataFrame:
    """Pieces (doc_id, row, start, length, ids_crc32, doc_tokens) of all documents; null text is empty."""
    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = Encoder.get(path), np.array([end_id], dtype="<u4").tobytes()
        for whole in batches:
            for batch in split(whole, "text", 1 << 20):
                texts, ids, rows = pc.fill_null(batch.column(1).cast(pa.string()), "").to_pylist(), batch.column(0).to_pylist(), []
                for doc_id, data in zip(ids, enc.batch(texts)):
                    data += end
                    n = len(data) // 4
                    rows += [(doc_id, s, m, zlib.crc32(data[4 * s : 4 * (s + m)]), n) for s, m in cuts(n, max_len)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_histogram(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[list[int], int]]:
    """Patterns (lengths, longest first; how many sequences) that hold every counted length once."""
    room: dict[int, list[tuple[list[int], int]]] = {}
    done: list[tuple[list[int], int]] = []
    free = np.zeros(max_len + 1, dtype=bool)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            spaces = np.flatnonzero(free[length:])
            if len(spaces):
                space = length + int(spaces[-1])  # the shortest pack
                pattern, n = room[space].pop()
            else:
                space, pattern, n = max_len, [], left
            used = min(n, left)
            if n > used:
                room[space].append((pattern, n - used))
            if space in room and not room[space]:
                free[space] = False
            left -= used
            if space == length:
                done.append(([*pattern, length], used))
            else:
                room.setdefault(space - length, []).append(([*pattern, length], used))
                free[space - length] = True
    return done + [p for s in sorted(room) for p in room[s]]


def places(patterns: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length, ranges of ranks in order: first rank, first sequence_id, offset."""
    out: dict[int, list[list[int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for lengths, n in patterns:
        offset = 0
        for x in lengths:
            out.setdefault(x, []).append([ranks.get(x, 0), sequence, offset])
            ranks[x] = ranks.get(x, 0) + n
            offset += x
        sequence += n
    return {x: np.array(v, dtype=np.int64) for x, v in out.items()}


def pack(docs: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    Each document's ids end with id 1, so an empty or null text is one id. Pieces of one length are interchangeable:
    which of them gets which place follows doc_id hashes, so reruns agree; exact repeats of a row may swap places.
    """
    pieces = materialize(tokenize(docs, tokenizer or default_tokenizer(), max_len))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most max_len rows
    where = places(pack_histogram(counts, max_len))
    ranked = salted_rank(pieces, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], F.xxhash64("doc_id", "start"), "_rank", salts_for(max(counts.values(), default=0)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seq, off = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            lengths, ranks = f["length"].to_numpy(), f["_rank"].to_numpy()
            for x in np.unique(lengths):
                mine, table = lengths == x, where[int(x)]
                at = np.searchsorted(table[:, 0], ranks[mine], side="right") - 1
                seq[mine], off[mine] = table[at, 1] + ranks[mine] - table[at, 0], table[at, 2]
            yield f.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "_rank").mapInPandas(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048; an empty table gives none. See pack for nulls, repeats and ties."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: pieces of all rows of docs, copies included; only doc_id and text are read, other columns may have any name."""
    return pack(docs)
