"""Quality rules with an isolation forest on rule statistics.

One pass over whole texts gives a row of rule statistics a document. Forests of random splits, one a group of rates, are
grown on the driver on a bounded sample of those rows (an isolation tree sees 256 rows by design); workers compute path
lengths of all rows. The thresholds come from histograms of the scores of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import split, texts
from .common import BASES, BYTE_CODES, IS_GAP, Words, covered, lean, materialize, mix, prefix_hash, small_batches, span_hash

#: Bound of the rows the forest is grown on, rows a tree, trees.
SAMPLE_ROWS, TREE_ROWS, TREES = 8192, 256, 100
#: Most of the labelled good documents that the threshold may reject.
GOOD_LOST = 0.002

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_alpha", "n_digits", "n_upper", "n_types"]
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Count of true items in each document's range."""
    at = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=at[1:])
    return at[offsets[1:]] - at[offsets[:-1]]


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    both = np.unique(mix(key ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    return np.bincount(doc[both], minlength=n)


def measure(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Rule statistics of each document in a buffer."""
    n = len(offsets) - 1
    words = Words(buf, offsets)
    out = {"n_words": words.count}
    char = (buf & 0xC0) != 0x80
    letter = ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 0xC3)
    out["word_chars"] = _sums(char & ~IS_GAP[buf], offsets)
    out["n_chars"] = _sums(char, offsets)
    out["n_symbols"] = _sums(_SYMBOLS[buf], offsets)
    out["n_alpha"] = _sums(letter, offsets)
    out["n_digits"] = _sums((buf >= 48) & (buf <= 57), offsets)
    out["n_upper"] = _sums((buf >= 65) & (buf <= 90), offsets)
    # lines: pieces between line feeds and document edges
    cut = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(buf == 10) + 1]))
    cut = cut[cut < len(buf)]
    doc = np.searchsorted(offsets, cut, side="right") - 1
    end = np.minimum(np.append(cut[1:], len(buf)), offsets[doc + 1])
    end = end - ((end > cut) & (buf[end - 1] == 10)) if len(cut) else end
    solid = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(~IS_GAP[buf], out=solid[1:])
    real = np.flatnonzero(solid[end] > solid[cut]) if len(cut) else np.zeros(0, int)
    lines = span_hash(prefix_hash(BYTE_CODES[buf], BASES[0]), cut[real], end[real], BASES[0])
    out["n_lines"] = np.bincount(doc[real], minlength=n)
    out["n_dup_lines"] = out["n_lines"] - _distinct(doc[real], lines, n)
    out["n_types"] = _distinct(words.doc, words.hash, n)
    # words in windows of five that occur twice or more in the text
    at = np.flatnonzero(words.fits(5))
    repeat = np.zeros(len(words.start), bool)
    if len(at):
        key = mix(words.windows(5, at) ^ mix(words.doc[at].astype(np.uint64) + np.uint64(1)))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        repeat = covered(at[times[which] > 1], 5, len(words.start))
    out["n_repeat_words"] = np.bincount(words.doc[repeat], minlength=n)
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep`` and the counts of COUNTS for each row of docs."""
    small_batches(docs.sparkSession)
    fields = [f for f in docs.schema if f.name in keep]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split(whole, "text", 1 << 19):
                got = measure(*texts(batch, "text"))
                cols = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array(got[c]) for c in COUNTS]], [*[f.name for f in fields], *COUNTS])

    return docs.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], *[f"{c} long" for c in COUNTS]]))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vectors(f: pd.DataFrame) -> list[np.ndarray]:
    """Rule statistics as rates, so that long and short documents compare, in groups of a forest each: in one forest of
    all, the spread that good documents have in some rates hides what is odd in others.

    Signs: symbols a word, symbols among symbols and letters, signs that are no letters in words, repeated lines.
    Variety: distinct words a word. Make of words: length, digits, upper case, words in repeated windows.
    """
    symbols, words, chars = f["n_symbols"], np.maximum(f["n_words"], 1), np.maximum(f["word_chars"], 1)
    groups = [
        [symbols / words, symbols / np.maximum(symbols + f["n_alpha"], 1), 1 - f["n_alpha"] / chars, f["n_dup_lines"] / np.maximum(f["n_lines"], 1)],
        [f["n_types"] / words],
        [f["word_chars"] / words, f["n_digits"] / chars, f["n_upper"] / chars, f["n_repeat_words"] / words],
    ]
    return [np.column_stack(g).astype(np.float64) for g in groups]


SCORES = ["_signs", "_variety", "_make"]


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Forest:
    """Isolation forest: each tree as arrays of (feature, cut, left, right, length at a leaf)."""

    def __init__(self, x: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.size = min(TREE_ROWS, len(x))
        depth = int(np.ceil(np.log2(max(2, self.size))))
        self.trees = [self._grow(x[rng.choice(len(x), self.size, replace=False)], depth, rng) for _ in range(TREES if len(x) > 1 else 0)]

    def _grow(self, x: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def node(rows: np.ndarray, level: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, level + _expected(len(rows))])
            low, high = rows.min(0), rows.max(0)
            can = np.flatnonzero(high > low)
            if level < depth and len(rows) > 1 and len(can):
                j = int(rng.choice(can))
                cut = rng.uniform(low[j], high[j])
                left = rows[:, j] < cut
                nodes[at][:2] = [j, cut]
                nodes[at][2] = node(rows[left], level + 1) if left.any() else at
                nodes[at][3] = node(rows[~left], level + 1) if (~left).any() else at
                if nodes[at][2] == at or nodes[at][3] == at:
                    nodes[at] = [-1, 0.0, at, at, level + _expected(len(rows))]
            return at

        node(x, 0)
        a = np.array(nodes)
        return a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher for rows that few random splits set apart."""
        if not self.trees:
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(x), int)
            while (feature[at] >= 0).any():
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[rows, f] < cut[at], left[at], right[at]))
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / max(_expected(self.size), 1e-9))


def grow(stats: DataFrame, good: DataFrame, draw: list[Column]) -> list[Forest]:
    """A forest a group of rates, on at most SAMPLE_ROWS rows that pass the base rules, the first in the order of ``draw``: seven in eight
    from ``good``, the rows labelled good, the rest from all. Where junk is common it would hide among its like."""
    first = lambda df, n: df.filter(~base_failed()).orderBy(*draw).limit(n).select(*COUNTS).toPandas()
    known = first(good, SAMPLE_ROWS * 7 // 8)
    rows = pd.concat([known, first(stats, max(1, len(known) // 7) if len(known) else SAMPLE_ROWS)], ignore_index=True)
    return [Forest(x, 11 + i) for i, x in enumerate(vectors(rows))]


def scored(stats: DataFrame, forests: list[Forest]) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(forests)  # TREES trees of 2 * TREE_ROWS nodes at most in each

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(**{c: np.round(forest.score(x), 6) for c, forest, x in zip(SCORES, shared.value, vectors(f))})

    return stats.mapInPandas(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema], *[f"{c} double" for c in SCORES]]))


#: Above all scores, so that all stay.
OFF = 2.0


def calibrate(labelled: DataFrame) -> list[float]:
    """Thresholds on SCORES from rows (scores, quality) that pass the base rules, one after another: what tells most bad
    ones from good ones among rows that are still in, while at most GOOD_LOST of all the good ones are above any. OFF
    where there is nothing to learn."""
    good, bad = labelled.agg(F.sum((F.col("quality") == 1).cast("long")), F.sum((F.col("quality") == 0).cast("long"))).first()
    limits: list[float] = []
    spent = 0
    for c in SCORES:
        left = labelled.filter(F.lit(True) if not limits else F.expr(" and ".join(f"`{k}` < {v}" for k, v in zip(SCORES, limits))))
        rows = left.groupBy(F.floor(F.col(c) * 1000).alias("bin")).agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
        h = rows.toPandas().sort_values("bin", ascending=False)  # 1001 bins at most
        limit = OFF
        if len(h) and good and bad:
            lost, caught = h["good"].cumsum(), h["bad"].cumsum()
            gain = (caught / bad - lost / good).where((spent + lost) / good <= GOOD_LOST, -1.0)
            best = gain.to_numpy().argmax()
            if gain.iloc[best] > 0:
                limit = float(h["bin"].iloc[best]) / 1000
                spent += int(lost.iloc[best])
        limits.append(limit)
    return limits


def anomaly(limits: list[float]) -> tuple[Column, float]:
    """One score and one threshold for SCORES and their thresholds: each score is moved so that its threshold meets that of
    the first in use, and the largest counts."""
    used = [(c, v) for c, v in zip(SCORES, limits) if v < OFF]
    if not used:
        return F.col(SCORES[0]), OFF
    limit = used[0][1]
    moved = [F.round(F.col(c) - F.lit(v) + F.lit(limit), 6) for c, v in used]
    return F.least(F.lit(1.0), F.greatest(*moved, F.lit(0.0))), limit


def judge(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (doc_id among them), COUNTS, anomaly, threshold, base_failed and kept for every row of docs.

    Null text has no words, so it fails the base rules. Labels with a null doc_id or quality, or of two minds about a
    document, are not used; without usable labels only the base rules decide.
    """
    stats = materialize(statistics(docs, keep))
    agreed = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_other")).filter(F.col("quality") == F.col("_other"))
    labelled = stats.join(agreed.select("doc_id", "quality"), "doc_id").filter(~base_failed())
    forests = grow(stats, labelled.filter(F.col("quality") == 1), [F.xxhash64(*keep, *COUNTS), *[F.col(c) for c in COUNTS]])
    value, limit = anomaly(calibrate(materialize(scored(labelled, forests).select("quality", *SCORES))))
    marked = scored(stats, forests).withColumn("anomaly", value).drop(*SCORES)
    return marked.withColumn("threshold", F.lit(limit)).withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & (F.col("anomaly") < F.lit(limit)))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, counts, anomaly, threshold, base_failed, kept of every document. Null and wordless texts fail the base rules; rows of one
    doc_id are judged each by its own text; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ["doc_id"])
    return out.select("doc_id", *COUNTS[:5], "anomaly", "threshold", "base_failed", "kept")
