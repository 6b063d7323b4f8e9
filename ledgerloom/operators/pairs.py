"""Pairs of rows in blocks by way of their kinds: what follows from two kinds is worked out once, whatever rows have them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.fuzzy import SCORERS, many_scores
from ..plans.scratch import materialize

#: Keys of a kind in one list; tasks that a block's lists are dealt to, at most.
LISTED, SALTS = 2048, 64
#: Rows of a block, on average, that lie in one tile and meet another tile's in one step; pairs sent at once.
TILE, SENT_PAIRS = 512, 1 << 16


def kind_pairs(rows: DataFrame, block: list[str], kind: str, key: str, listed: int | None = None) -> DataFrame:
    """rows(block, kind, key) -> (x, y, _a, _b): kinds of a block and lists of their keys, such that each pair of keys a < b in the
    block is in one of them, a among those of x and b among those of y.

    A list is bounded, and each list of a block meets the others in a salt of its own (up to SALTS), in as many
    tasks as the session's shuffles have, so neither copies of a kind nor a large block meet in one task. Rows with a null in block or key have no pair.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*block, key)])
    own = rows.filter(known).select(*block, F.col(kind).alias("_kind"), F.col(key).alias("_key"))
    counts = own.groupBy(*block, "_kind").agg(F.ceil(F.count(F.lit(1)) / (LISTED if listed is None else listed)).alias("_parts")).filter("_parts > 1")
    right = counts.select(*[F.col(c).alias(f"_k_{c}") for c in block], F.col("_kind").alias("_k_kind"), "_parts")
    same = reduce(lambda a, b: a & b, [own[c] == right[f"_k_{c}"] for c in block], own["_kind"].eqNullSafe(right["_k_kind"]))
    dealt = own.join(right, same, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_key"), "_parts"), F.lit(0)))
    lists = materialize(dealt.groupBy(*block, "_kind", "_part").agg(F.collect_list("_key").alias("_keys"), F.min("_key").alias("_low"), F.max("_key").alias("_high")))
    salts = lists.groupBy(*block).agg(F.least(F.count(F.lit(1)), F.lit(SALTS)).cast("int").alias("_salts"))
    met = lists.join(salts, block)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given by number: the lists are small, their pairs are not
    left = met.select(*block, F.pmod(F.xxhash64("_kind", "_part"), "_salts").cast("int").alias("_salt"), F.col("_kind").alias("x"), F.col("_keys").alias("_a"), F.col("_low").alias("_from")).repartition(n, *block, "_salt")
    each = met.select(*block, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), F.col("_kind").alias("y"), F.col("_keys").alias("_b"), F.col("_high").alias("_to")).repartition(n, *block, "_salt")
    return left.join(each, [*block, "_salt"]).filter(F.col("_from") < F.col("_to")).select("x", "y", "_a", "_b")


def expand(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs of kinds with what was worked out for them -> the rows' pairs, a < b."""
    out = pairs.withColumn(a, F.explode("_a")).drop("_a").withColumn(b, F.explode("_b")).drop("_b")
    return out.filter(F.col(a) < F.col(b))


def tiles(rows: DataFrame, block: list[str], key: str, name: str, tile: int | None = None) -> DataFrame:
    """rows(block, key, name) -> (_a, _b): lists of (_key, _name), such that every two rows of a block, in either order, are in one pair of lists.

    Rows of a block are dealt to tiles by their keys' hash, however many share a name, and every two tiles meet on their own, in as many tasks as
    the session's shuffles have. Rows with a null in block or key are left out.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*block, key)])
    own = rows.filter(known).select(*block, F.col(key).alias("_key"), F.col(name).alias("_name"))
    sizes = own.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / (tile or TILE)).cast("int").alias("_tiles"))
    dealt = own.join(sizes, block).withColumn("_tile", F.pmod(F.xxhash64("_key", "_name"), "_tiles").cast("int"))
    lists = materialize(dealt.groupBy(*block, "_tiles", "_tile").agg(F.collect_list(F.struct("_key", "_name")).alias("_rows")))
    n, each = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    met = [*block, "_left", "_right"]  # given by number: the lists are small, their pairs are not
    left = lists.select(*block, F.col("_tile").alias("_left"), each.alias("_right"), F.col("_rows").alias("_a")).repartition(n, *met)
    right = lists.select(*block, F.col("_tile").alias("_right"), each.alias("_left"), F.col("_rows").alias("_b")).repartition(n, *met)
    return left.join(right, met).select("_a", "_b")


def scored_pairs(met: DataFrame, kinds: tuple[str, ...] = tuple(SCORERS)) -> DataFrame:
    """Pairs of lists (tiles) -> (x, y, scores): names of each two rows with key a < key b, null where a name is. Two names of a pair of lists are
    scored once, whatever rows have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                (left, x), (right, y) = ((s.values.field(0).to_numpy(zero_copy_only=False), s.values.field(1).to_pylist()) for s in (a, b))
                names = sorted({n for n in (*x, *y) if n is not None})
                number = {n: k for k, n in enumerate(names)} | {None: len(names)}
                own, other, wide = np.array([number[n] for n in x]), np.array([number[n] for n in y]), len(names) + 1
                i, j = np.nonzero(left[:, None] < right[None, :])
                pair = own[i] * wide + other[j]
                used = np.zeros(wide * wide, bool)
                used[pair] = True
                used = used.reshape(wide, wide)
                used[-1], used[:, -1] = False, False
                score, told = many_scores(names, *np.nonzero(used), kinds), np.full(wide * wide, -1)
                told[used.ravel()] = np.arange(int(used.sum()))
                words = pa.array([*names, None], pa.string())
                for at in range(0, len(pair), SENT_PAIRS):
                    some = pair[at : at + SENT_PAIRS]
                    place, null = told[some], told[some] < 0
                    values = [pa.array(np.append(score[k], 0)[place], pa.int32(), mask=null) for k in kinds]
                    yield pa.RecordBatch.from_arrays([words.take(pa.array(some // wide)), words.take(pa.array(some % wide)), *values], ["x", "y", *kinds])

    return met.mapInArrow(run, "x string, y string, " + ", ".join(f"{k} int" for k in kinds))


def scored_names(pairs: DataFrame, x: str, y: str, kinds: dict[str, str], least: tuple[str, int] | None = None) -> DataFrame:
    """pairs(x, y), no null, with the scores ``kinds`` (column: scorer) of both; of them those whose score in the column least[0] is least[1] or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(k).to_pylist() for k in (0, 1)]
            names = list(dict.fromkeys([*sides[0], *sides[1]]))
            number = {n: k for k, n in enumerate(names)}
            i, j = (np.array([number[n] for n in side], np.int64) for side in sides)
            score = many_scores(names, i, j, tuple(kinds.values()))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(score[k], pa.int32()) for k in kinds.values()]], [x, y, *kinds])
            yield out.filter(pa.array(score[kinds[least[0]]] >= least[1])) if least else out

    return pairs.select(x, y).mapInArrow(run, f"{x} string, {y} string, " + ", ".join(f"{k} int" for k in kinds))
