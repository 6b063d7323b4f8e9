"""Spelling variants: words that are one edit apart, by forward and reversed sorted dictionaries.

One inserted, deleted or replaced code point leaves a half of the shorter of two words intact: its first or its last
floor(m/2) code points. So every word stands in blocks of words that share a prefix (the forward dictionary) and in
blocks that share a suffix (the reversed one), once for each length m that the shorter word of a pair can have. Blocks
with many words are divided: within what they do not share the same holds again, so each goes into blocks that share half of the
rest, at its front or at its back. A pair is counted in one block alone: at the front if it can be, else at the back.
Blocks lie in sorted ranges, a task scans its range a block at a time, verifies pairs, and sends for each
word and block only how many words are near and the best of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import lean, materialize, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that a block may have before it is divided, where something is left that can be.
BLOCK_WORDS = 512
#: Pairs and rows that are compared at once.
PAIRS, ROWS = 1 << 20, 1 << 16


def runs(text: Column, least: int) -> Column:
    """Maximal runs [A-Za-z\\u00C0-\\u00FF]+ of at least that many code points, only A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"[a-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))


def misspelt(doc: Column, run: Column, every: int = 199) -> Column:
    """The run without one code point where ``every`` divides the crc32 of ``<doc>:<run>``; a null doc counts as empty text."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def dictionary(docs: DataFrame, least: int = 6, occurs: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points that occur at least ``occurs`` times in whole texts; null texts have none."""
    found = docs.select(F.col("doc_id").alias("doc"), F.explode(runs(F.col("text"), least)).alias("run"))
    said = found.select(misspelt(F.col("doc"), F.col("run"), every).alias("word")).filter(F.length("word") >= least)
    return said.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= occurs)


# ---- blocks --------------------------------------------------------------------------------------------------------


def _sides(df: DataFrame, least: int | None = None) -> DataFrame:
    """Rows in the blocks of the next division: half of what is not shared yet, at the front and at the back.

    A block is known by m (length of the shorter word of its pairs), p and s (code points shared at the front and at the back)
    and them. Pairs that share ``below`` code points at the front or more are counted elsewhere.
    """
    half = F.floor((F.col("m") - F.col("p") - F.col("s")) / 2).cast("int")
    front = F.struct((F.col("p") + half).alias("p"), F.col("s").alias("s"), F.col("below").alias("below"))
    back = F.struct(F.col("p").alias("p"), (F.col("s") + half).alias("s"), F.least(F.col("below"), F.col("p") + half).alias("below"))
    sides = df.withColumn("_side", F.explode(F.array(front, back))).select("word", "n", "m", "_side.*").filter(F.col("p") < F.col("below"))
    shared = (F.substring("word", F.lit(1), F.col("p")), F.substring(F.col("word"), F.length("word") - F.col("s") + 1, F.col("s")))
    return sides.withColumn("block", F.concat_ws("|", "m", "below", "p", "s", *shared))


def blocks(words: DataFrame, least: int = 6, most: int | None = None, keep: list[str] | None = None) -> list[DataFrame]:
    """Tables (word, n, m, p, s, below, block) whose blocks hold every pair of near words once; ``most``: words a block."""
    most = most or BLOCK_WORDS
    size = F.length("word")
    lengths = words.withColumn("m", F.explode(F.when(size > least, F.array(size - 1, size)).otherwise(F.array(size))))
    level = materialize(_sides(lengths.withColumns({"p": F.lit(0), "s": F.lit(0), "below": F.lit(1 << 30)})), keep)
    ready = []
    while True:
        # what is left of a word once p + s are shared has m - p - s code points or one more; from two on it can be halved
        large = materialize(level.groupBy("block").agg(F.count(F.lit(1)).alias("words"), F.first("m").alias("m"), F.first("p").alias("p"), F.first("s").alias("s")).filter((F.col("words") > most) & (F.col("m") - F.col("p") - F.col("s") >= 2)).select("block"), keep)
        if not large.head(1):
            return [*ready, level]
        ready.append(level.join(large, "block", "left_anti"))
        level = materialize(_sides(level.join(large, "block", "left_semi")), keep)


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), np.uint8).reshape(len(parts), width)


def near_pairs(words: list[bytes], block: np.ndarray, m: int, p: int, s: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes i < j of words of one block (runs of equal values) that are one edit apart, the shorter of m bytes, and share fewer than below bytes in front."""
    size = np.array([len(x) for x in words])
    rest = m - p - s
    body = _matrix([x[p : len(x) - s] for x in words], rest + 1)
    last = np.searchsorted(block, block, side="right")
    after = last - np.arange(len(words)) - 1
    upto = np.concatenate([[0], np.cumsum(after)])
    out, at = [], 0
    while at < len(words):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, side="right")) - 1)
        count = after[at:end]
        i = np.repeat(np.arange(at, end), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        at = end
        a, b = np.where(size[i] <= size[j], i, j), np.where(size[i] <= size[j], j, i)
        right = size[a] == m  # two words of m + 1 are of another block
        a, b = a[right], b[right]
        x, y, more = body[a][:, :rest], body[b], size[b] > m
        differs = x != y[:, :rest]
        first = np.where(differs.any(1), differs.argmax(1), rest)
        shifted = x != y[:, 1:]
        later = np.where(shifted.any(1), rest - 1 - shifted[:, ::-1].argmax(1), -1)
        ok = np.where(more, later < first, differs.sum(1) == 1) & (p + first < below)
        out.append((a[ok], b[ok]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _best(words: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    """For each word with near ones: how many, and the best: the largest n, then the first in code-point order."""
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    used, where = np.unique(dst, return_inverse=True)
    rank = np.argsort(np.argsort(np.array([words[u] for u in used], dtype=object), kind="stable"), kind="stable")
    order = np.lexsort((rank[where], -n[dst], src))
    src, dst = src[order], dst[order]
    first = np.flatnonzero(np.append(True, src[1:] != src[:-1])) if len(src) else np.zeros(0, int)
    near = np.diff(np.append(first, len(src)))
    text = lambda at: pa.array([words[k].decode("latin-1") for k in at.tolist()], pa.string())
    return pa.RecordBatch.from_arrays([text(src[first]), pa.array(near, pa.int64()), pa.array(n[dst[first]], pa.int64()), text(dst[first])], ["word", "near", "best_n", "best"])


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan a sorted range of blocks; a chunk is cut between two blocks, so that no more than some rows and one block are held."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key = table["block"].combine_chunks()
        words = [w.encode("latin-1") for w in table["word"].to_pylist()]
        n = table["n"].to_numpy()
        block = np.concatenate([[0], np.cumsum(np.asarray(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)))]) if len(key) else np.zeros(0, int)
        shape = np.stack([table[c].to_numpy() for c in ("m", "p", "s", "below")])
        kinds, of = np.unique(shape, axis=1, return_inverse=True)
        of = of.ravel()
        for k in range(kinds.shape[1]):
            mine = np.flatnonzero(of == k)
            m, p, s, below = kinds[:, k].tolist()
            a, b = near_pairs([words[x] for x in mine.tolist()], block[mine], m, p, s, below)
            if len(a):
                yield _best([words[x] for x in mine.tolist()], n[mine], a, b, block[mine])

    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= ROWS:
            table = pa.concat_tables(held).combine_chunks()
            key = table["block"]
            cut = table.num_rows
            last = key[cut - 1].as_py()
            same = pc.equal(key, last).to_numpy(zero_copy_only=False)
            cut = int(np.argmax(same))  # where the last block begins
            if cut:
                yield from settle(table.slice(0, cut))
            held, rows = [table.slice(cut)], table.num_rows - cut
    if rows:
        yield from settle(pa.concat_tables(held).combine_chunks())


def near_words(words: DataFrame, least: int = 6, most: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """(word, n_near, form_n, best): for each word of words(word, n) with words one edit away, how many and the best of them."""
    found = None
    for table in blocks(words, least, most, keep):
        ranges = table.repartitionByRange(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block")
        part = ranges.select("block", "word", "n", "m", "p", "s", "below").mapInArrow(lean(scan), "word string, near long, best_n long, best string")
        found = part if found is None else found.unionByName(part)
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top")).select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))


def variants(words: DataFrame, ratio: int = 5, least: int = 6, most: int | None = None) -> DataFrame:
    """words(word, n) -> word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n (ties: the first in code-point order) if that n is at least ``ratio`` times the word's.
    Forms grow by that ratio from step to step, which bounds how far a root can be; roots are found by doubling.
    """
    keep: list[str] = []
    near = near_words(words, least, most, keep)
    has = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    told = materialize(
        words.join(near, "word", "left").select("word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n"))
    )
    release(words.sparkSession, keep)
    steps = told.filter("form is not null").select("word", F.col("form").alias("root"))
    ends = told.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    depth = math.ceil(math.log(max(1, ends["most"] / ends["least"]), ratio)) + 1 if ends["most"] else 1
    for _ in range(max(0, math.ceil(math.log2(depth)))):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = materialize(steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")))
    return told.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of documents that occurs five times or more.

    Null and empty texts have no words, a null doc_id counts as empty text; rows that repeat count each time; texts and runs of any length
    are read whole; an empty table gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(materialize(dictionary(docs)))


_crc = "range(256)"
for _ in range(8):
    _crc = f"list_transform({_crc}, lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"

#: DuckDB SQL of op11_spelling; crc32 is made byte by byte from the table of its rule, near words meet in what is left without one code point.
ORACLE = f"""WITH RECURSIVE tab AS (SELECT {_crc} AS crc),
 runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
 hexed AS (SELECT *, hex(encode(doc_id || ':' || run)) AS h FROM runs),
 hashed AS (SELECT run, k, xor(list_reduce(list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)), lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)]), 4294967295), 4294967295) AS h FROM hexed, tab),
 words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed) WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
 cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS part FROM (SELECT word, n, CAST(unnest(range(length(word))) AS BIGINT) AS i FROM words)),
 near AS (SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.part = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.part = b.word),
 best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY 1),
 told AS (SELECT w.word, CASE WHEN m >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
 path AS (SELECT word, word AS at FROM told UNION ALL SELECT path.word, t.form FROM path JOIN told t ON path.at = t.word WHERE t.form IS NOT NULL)
 SELECT told.word, told.form, path.at AS root, told.n, told.n_near, told.form_n FROM told JOIN path ON told.word = path.word JOIN told e ON path.at = e.word WHERE e.form IS NULL"""
