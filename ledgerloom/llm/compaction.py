"""Executed bin-packed compaction: small Parquet files of a folder are joined, first fit by descending size.

A table is written as files of lots (``write_lots``), the files are listed with the rows that they really hold
(``file_rows``), groups are planned a partition of the table at a time (``plan``), each group is read in the order of its
files and rows and appended as one file, and its sources are deleted (``compact``). Rows move through Spark only: a file
is one task that sorts outside of memory, as a whole file is asked for. A plan has one row a file; files are as many
as lots, whose number follows days and not rows.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.ranking import global_rank
from .common import fresh, materialize, release, scratch_dir


class Residuals:
    """Groups in the order opened, found by what they can still hold.

    Bucket b is a min-heap of the indexes of groups that can hold 2**b to 2**(b+1)-1 more rows. For a file all groups of
    the buckets above its own are sufficient, so their heads alone are compared; in its own bucket, the boundary, heads
    are taken in order until one is verified to be sufficient. An entry is stale once its group left the bucket.
    """

    def __init__(self, capacity: int):
        self.capacity, self.left, self.heaps = capacity, [], [[] for _ in range(max(1, capacity).bit_length())]

    def _head(self, b: int) -> int | None:
        heap = self.heaps[b]
        while heap and self.left[heap[0]].bit_length() - 1 != b:
            heapq.heappop(heap)
        return heap[0] if heap else None

    def place(self, size: int) -> int:
        """Index of the earliest group that holds size more rows; a new one if there is none. A file beyond the capacity stands alone."""
        if size <= 0:
            raise ValueError("a file without rows has no place")
        boundary, best = size.bit_length() - 1, None
        for b in range(boundary + 1, len(self.heaps)):
            head = self._head(b)
            if head is not None and (best is None or head < best):
                best = head
        aside = []
        while boundary < len(self.heaps) and (head := self._head(boundary)) is not None and (best is None or head < best):
            if self.left[head] >= size:
                best = head
            else:
                aside.append(heapq.heappop(self.heaps[boundary]))
        for g in aside:
            heapq.heappush(self.heaps[boundary], g)
        if best is None:
            best = len(self.left)
            self.left.append(self.capacity)
            before = -1
        else:
            before = self.left[best].bit_length() - 1
        self.left[best] -= size
        now = self.left[best].bit_length() - 1 if self.left[best] > 0 else -1
        if now >= 0 and now != before:
            heapq.heappush(self.heaps[now], best)
        return best


def pack(sizes: list[int], capacity: int) -> list[int]:
    """First fit of sizes in the given order: the group of each."""
    groups = Residuals(capacity)
    return [groups.place(s) for s in sizes]


def steps(rows: int, x: int) -> int:
    """1 + floor(rows / x), a size that follows the table."""
    return 1 + rows // x


def crc(column: Column) -> Column:
    """Unsigned crc32 of a value as decimal text; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def with_lots(df: DataFrame, time: str, key: str, names: list[str], lot_x: int = 200) -> tuple[DataFrame, int]:
    """Columns day, lot and piece (called ``names``) for every row, and the table's number of rows. A null time has the day null."""
    day, lot, piece = names
    n, same = fresh(df.withColumns({c: F.lit(0) for c in names}), "_rows", "_day")
    dated = df.withColumn(day, F.unix_date(F.col(time).cast("date")).cast("long"))
    days = materialize(dated.groupBy(F.col(day).alias(same)).agg(F.count(F.lit(1)).alias(n)))
    rows = days.agg(F.sum(n)).first()[0] or 0
    h = crc(F.col(key))
    lots = F.expr(f"1 + `{n}` div {steps(rows, lot_x)}")
    placed = dated.join(days, F.col(day).eqNullSafe(F.col(same)))
    return placed.withColumns({lot: F.shiftright(h, 4) % lots, piece: F.least(h % 4, F.shiftright(h, 2) % 4)}).drop(n, same), rows


def write_lots(df: DataFrame, folder: str, time: str, key: str, lot_x: int = 200) -> tuple[DataFrame, int]:
    """Write df into folder, a file for each occurring (day, lot, piece), its rows by time, then key, all columns in order.

    Returns the table (no, day, lot, piece, n) of what was written, ``no`` being the number in the file's name, and the
    number of rows. Rows that tie in time and key are ordered by a hash of all columns, so a rerun gives the same files.
    """
    names = fresh(df, "_day", "_lot", "_piece")
    placed, rows = with_lots(df, time, key, names, lot_x)
    found = placed.groupBy(*[F.col(c).alias(o) for c, o in zip(names, ("day", "lot", "piece"))]).agg(F.count(F.lit(1)).alias("n"))
    files = materialize(global_rank(found, [F.col(c).asc_nulls_first() for c in ("day", "lot", "piece")], "no").withColumn("no", F.col("no").cast("int") - 1))
    total = files.count()
    if total:
        (no,) = [fresh(placed, "_no")]
        theirs = files.select(*[F.col(o).alias(f"_of{c}") for c, o in zip(names, ("day", "lot", "piece"))], F.col("no").alias(no))
        same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in names]
        dealt = placed.join(theirs, same[0] & same[1] & same[2])
        tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])
        append(dealt, folder, no, total, [F.col(time), F.col(key), tie], df.columns)
    return files, rows


def append(df: DataFrame, folder: str, no: str, files: int, order: list[Column], columns: list[str]) -> None:
    """Append one file for each value 0..files-1 of the column no, its rows in order; the number of a file is in its name."""
    whole = df.repartitionById(files, F.col(no)).sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in columns])
    whole.write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)


def stored(spark: SparkSession, paths: list[str], schema, *more: Column) -> DataFrame:
    """Rows of files with _file (name) and _row (place in it) beside ``more``."""
    df = spark.read.schema(schema).parquet(*paths)
    meta = df.metadataColumn("_metadata")
    return df.select(*more, meta["file_name"].alias("_file"), meta["row_index"].alias("_row"))


def file_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    """(name, no, n): the files of a folder, the number in their names and the rows that they hold."""
    return stored(spark, [folder], schema).groupBy(F.col("_file").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("no", F.regexp_extract("name", r"^part-(\d+)", 1).cast("int"))


def plan(files: DataFrame, small: int, capacity: int) -> DataFrame:
    """files(day, lot, piece, n, name) -> (day, grp, place, lot, piece, name) of the files that are joined with others.

    In each day files of fewer than ``small`` rows are taken by descending rows, then lot, then piece, each into the
    earliest group that holds at most ``capacity`` rows with it. Groups of one file are left out.
    """

    def day(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "descending"), ("lot", "ascending"), ("piece", "ascending"), ("name", "ascending")])
        groups = pack(table["n"].to_pylist(), capacity)
        members: dict[int, int] = {}
        place = []
        for g in groups:
            place.append(members.get(g, 0))
            members[g] = place[-1] + 1
        out = table.select(["day", "lot", "piece", "name"]).append_column("grp", pa.array(groups, pa.int32())).append_column("place", pa.array(place, pa.int32()))
        return out.filter(pa.array([members[g] > 1 for g in groups], pa.bool_())).select(["day", "grp", "place", "lot", "piece", "name"])

    return files.filter(F.col("n") < small).groupBy("day").applyInArrow(day, "day long, grp int, place int, lot long, piece long, name string")


def compact(spark: SparkSession, folder: str, schema, members: DataFrame) -> DataFrame:
    """Write each group of members (day, grp, place, name, ...) as one file of the folder and delete its sources.

    Sources are concatenated in the order of ``place``. New files are committed before a source is deleted, so no row is
    ever missing; a run that ends in between leaves sources beside their group's file, and ``members`` says which.
    Returns (day, grp, no): the number in the name of each group's file.
    """
    groups = materialize(global_rank(members.select("day", "grp").distinct(), [F.asc_nulls_first("day"), F.asc("grp")], "no").withColumn("no", F.col("no").cast("int") - 1))
    total = groups.count()
    if total:
        sources = sorted(r["name"] for r in members.select("name").collect())  # a name a small file
        columns = schema.fieldNames()
        name, no, place, row = fresh(spark.createDataFrame([], schema), "_name", "_no", "_place", "_at")
        theirs = members.join(groups, members["day"].eqNullSafe(groups["day"]) & (members["grp"] == groups["grp"])).select(F.col("name").alias(name), F.col("no").alias(no), F.col("place").alias(place))
        df = spark.read.schema(schema).parquet(*[f"{folder}/{s}" for s in sources])
        meta = df.metadataColumn("_metadata")
        rows = df.withColumns({f"{name}_of": meta["file_name"], row: meta["row_index"]}).join(theirs, F.col(f"{name}_of") == F.col(name))
        append(rows, folder, no, total, [F.col(place), F.col(row)], columns)
        release(spark, [f"{folder}/{s}" for s in sources])
    return groups


def digests(spark: SparkSession, folder: str, schema, key: str, value: str) -> DataFrame:
    """(name, n_rows, min_key, max_key, cents, ids_sha256) of every file of a folder, as read back in file order.

    Rows of a file stream through one task; nothing of a file is held but the running hash.
    """
    cents = F.coalesce(F.floor(F.lit(100) * F.col(value) + F.lit(0.5)).cast("long"), F.lit(0))
    rows = stored(spark, [folder], schema, F.col(key).cast("long").alias("_key"), cents.alias("_cents"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def row() -> pa.RecordBatch:
            n, least, most, total, sha = state
            fields = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((name, n, least, most, total, sha.hexdigest()), fields)], ["name", "n_rows", "min_key", "max_key", "cents", "ids_sha256"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            ends = pc.run_end_encode(table["_file"].combine_chunks())
            at = 0
            for file, end in zip(ends.values.to_pylist(), ends.run_ends.to_pylist()):
                part = table.slice(at, end - at)
                at = end
                if file != name:
                    if name is not None:
                        yield row()
                    name, state = file, [0, None, None, 0, hashlib.sha256()]
                ids = part["_key"]
                text = ",".join(pc.fill_null(pc.cast(ids, pa.string()), "").to_pylist())
                state[4].update(("," if state[0] else "").encode() + text.encode())
                ends_of = pc.min_max(ids)
                for k, pick in ((1, min), (2, max)):
                    v = ends_of["min" if k == 1 else "max"].as_py()
                    state[k] = v if state[k] is None else state[k] if v is None else pick(state[k], v)
                state[0] += part.num_rows
                state[3] += pc.sum(part["_cents"]).as_py() or 0
        if name is not None:
            yield row()

    ordered = rows.repartition("_file").sortWithinPartitions("_file", "_row")
    return ordered.mapInArrow(digest, "name string, n_rows long, min_key long, max_key long, cents long, ids_sha256 string")


def op12_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes clicks as files of lots into a new folder under spark.checkpoint.dir, compacts them there, and tells of each file left.

    Null click_ids hash as empty text and count as empty in ids_sha256; a null arrived_at is the day null, and its rows
    come first in no other file; null values count 0 cents. Repeated rows stay. Columns of any name are kept. An empty
    table gives no row and a folder without data files.
    """
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet")
    folder = f"{scratch_dir(spark)}/clicks-{uuid.uuid4().hex}"
    kinds = "day long, lot long, piece long, n_rows long, min_click_id long, max_click_id long, cents long, sources string, ids_sha256 string, columns string, path string, rewritten boolean"
    written, rows = write_lots(clicks, folder, "arrived_at", "click_id")
    if not rows:
        release(spark, [folder])
        return spark.createDataFrame([], kinds)
    found = file_rows(spark, folder, clicks.schema)
    files = materialize(found.join(written.drop("n"), "no").select("day", "lot", "piece", "n", "name"))
    members = materialize(plan(files, steps(rows, 750), steps(rows, 400)))
    groups = compact(spark, folder, clicks.schema, members)
    said = materialize(digests(spark, folder, clicks.schema, "click_id", "value"))
    left = said.agg(F.sum("n_rows")).first()[0]
    if left != rows:
        raise RuntimeError(f"{folder} holds {left} rows of {rows}")
    label = F.concat_ws("-", "lot", "piece")
    kept = said.join(files, "name").select("name", "day", "lot", "piece", label.alias("sources"), F.lit(False).alias("rewritten"))
    first = lambda c: F.min_by(c, "place").alias(c)
    joined = members.groupBy(F.col("day").alias("d"), F.col("grp").alias("g")).agg(first("lot"), first("piece"), F.array_sort(F.collect_list(F.struct("place", label.alias("label")))).alias("of"))
    joined = joined.join(groups, F.col("d").eqNullSafe(F.col("day")) & (F.col("g") == F.col("grp"))).select("no", "day", "lot", "piece", F.array_join(F.col("of.label"), ",").alias("sources"))
    fresh_files = said.join(files.select("name"), "name", "left_anti").select("name", F.regexp_extract("name", r"^part-(\d+)", 1).cast("int").alias("no"))
    told = kept.unionByName(fresh_files.join(joined, "no").select("name", "day", "lot", "piece", "sources", F.lit(True).alias("rewritten")))
    columns = ",".join(spark.read.parquet(folder).columns)
    return said.join(told, "name").select(
        "day", "lot", "piece", "n_rows", F.col("min_key").alias("min_click_id"), F.col("max_key").alias("max_click_id"), "cents", "sources", "ids_sha256", F.lit(columns).alias("columns"), F.concat(F.lit(folder + "/"), F.col("name")).alias("path"), "rewritten"
    )
