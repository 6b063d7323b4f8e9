"""Delimited files of any size, read in byte ranges by many tasks.

Whether a line begins a record depends on all quotes before it. Each range is summed up as a function of the state that it
begins in (outside or inside of a quoted field): the state that it ends in and the records that it begins. The functions are
composed along each file (one row a range), and ranges are then parsed from their true record starts. A record that
lies in one range is parsed there; pieces of a record that ranges share meet by its number. Rows carry the number of
their record and of its first line in the file, so that what is dropped later can be traced.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.scratch import materialize
from .files import decode, delimiter, rows_of

DELIMITERS = ",\t;|"
#: Bytes of a file's beginning that tell its kind and delimiter.
HEAD = 1 << 15
#: Ranges whose states are sent to all tasks; beyond, lines are dealt to their ranges.
BROADCAST_RANGES = 100_000
#: Bytes of a record of several ranges; a longer one is an error, as a field of so many characters is.
LONGEST = 1 << 24
MAGIC = ((b"PK\x03\x04", "xlsx"), (b"\xd0\xcf\x11\xe0", "xls"), (b"%PDF-", "pdf"))


def quoted_after(line: bytes, delim: bytes, quoted: bool) -> bool:
    """Whether a line that begins inside (or outside) of a quoted field ends inside of one. A quote opens a field only where a field begins."""
    at = 0
    while True:
        if quoted:
            at = line.find(b'"', at)
            if at < 0:
                return True
            at += 1
            if line[at : at + 1] == b'"':  # a doubled quote is text
                at += 1
                continue
            quoted = False
        elif line[at : at + 1] == b'"':
            quoted, at = True, at + 1
            continue
        at = line.find(delim, at) + 1
        if not at:
            return False


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, start, seq, utf8, line): lines of files as bytes without their newline, by start (of the range) and seq in their order."""
    df = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    meta = df.metadataColumn("_metadata")
    return df.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("seq"), F.is_valid_utf8("value").alias("utf8"), F.col("value").cast("binary").alias("line"))


def _pieces(line: bytes) -> list[bytes]:
    """A line with its newline, cut at lone carriage returns, which end a record as newlines do."""
    if b"\r" not in line[:-1]:
        return [line + b"\n"]
    last = line.endswith(b"\r")
    cut = line.removesuffix(b"\r").split(b"\r")
    return [*(x + b"\r" for x in cut[:-1]), cut[-1] + (b"\r\n" if last else b"\n")]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of batches by runs of equal (path, start), cut where a batch ends: (key, rows)."""
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        at = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][:2] != rows[at][:2]:
                yield rows[at][:2], rows[at:i]
                at = i


SUMMARY = "path string, start long, lines long, utf8 boolean, head binary, quoted array<boolean>, records array<long>"


def summaries(lines: DataFrame) -> DataFrame:
    """One row a range: lines, first bytes if it lies in the file's head, and for each delimiter and both states at its beginning its end state and records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, good, head, quoted, records = None, 0, True, b"", [], []

        def row() -> pa.RecordBatch:
            fields = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.bool_()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, n, good, head, quoted, records), fields)], ["path", "start", "lines", "utf8", "head", "quoted", "records"])

        for now, rows in _runs(batches):
            if now != key:
                if key is not None:
                    yield row()
                key, n, good, head, quoted, records = now, 0, True, b"", [False, True] * len(DELIMITERS), [0] * 2 * len(DELIMITERS)
            for *_, utf8, line in rows:
                good = good and utf8
                for piece in _pieces(line):
                    n += 1
                    if key[1] < HEAD and len(head) < HEAD:
                        head = (head + piece)[:HEAD]
                    records = [r + (not q) for r, q in zip(records, quoted)]
                    if b'"' in piece:
                        quoted = [quoted_after(piece, DELIMITERS[k // 2].encode(), q) for k, q in enumerate(quoted)]
        if key is not None:
            yield row()

    return lines.select("path", "start", "utf8", "line").mapInArrow(run, SUMMARY)


def kind_of(head: bytes, path: str) -> str:
    """xlsx, xls, pdf or csv by the first bytes, then by the extension."""
    low = path.lower()
    return next((k for magic, k in MAGIC if head.startswith(magic)), None) or next((k for k in ("xlsx", "xls", "pdf") if low.endswith("." + k)), "csv")


PLAN = "path string, start long, kind string, delim string, quoted boolean, record long, line long"


def states(found: DataFrame) -> DataFrame:
    """How each range begins: kind and delimiter of its file, state, and how many records and lines come before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, held, head, known, state = None, [], b"", None, (False, 0, 0)

        def settle() -> list[tuple]:
            nonlocal known, state, held
            if known is None:
                kind = kind_of(head, path)
                known = (kind, delimiter(decode(head)) if kind == "csv" else ",")
            out = []
            for start, lines, quoted, records in held:
                q, record, line = state
                out.append((path, start, *known, q, record, line))
                k = 2 * DELIMITERS.index(known[1]) + q
                state = (quoted[k], record + records[k], line + lines)
            held = []
            return out

        def table(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["path", "start", "kind", "delim", "quoted", "record", "line"])

        for batch in batches:
            for p, start, lines, first, quoted, records in zip(*(c.to_pylist() for c in batch.columns)):
                if p != path:
                    yield from table(settle() if path is not None else [])
                    path, head, known, state = p, b"", None, (False, 0, 0)
                held.append((start, lines, quoted, records))
                head = (head + first)[:HEAD]
                if len(head) == HEAD or known:
                    yield from table(settle())
        yield from table(settle() if path is not None else [])

    ordered = found.select("path", "start", "lines", "head", "quoted", "records").repartition("path").sortWithinPartitions("path", "start")
    return ordered.mapInArrow(run, PLAN)


PARSED = "path string, record long, line long, cells array<string>, error string, start long, piece binary"


def _parse(data: bytes, utf8: bool, delim: str, first: bool) -> tuple[list[list[str]] | None, str | None]:
    text = data.decode("utf-8" if utf8 else "latin-1")
    try:
        return list(csv.reader(io.StringIO(text.removeprefix("﻿") if first else text, newline=""), delimiter=delim)), None
    except csv.Error as e:
        return None, str(e)


def _parse_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges that come in their order, with how they begin; the pieces of records that begin before or end after their range apart."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.int64(), pa.binary())
    key, out = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal out
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["path", "record", "line", "cells", "error", "start", "piece"])
        out = []

    def add(data: list[bytes], record: int, line: int, whole: bool) -> None:
        text = b"".join(data)
        if not whole:
            out.append((key[0], record, line, None, None, key[1], text))
            return
        rows, error = _parse(text, utf8, delim, record == 0)
        out.append((key[0], record, line, rows[0] if rows else [] if error is None else None, error, None, None))

    for now, rows in _runs(batches):
        if now != key:
            if key is not None and data:
                add(data, record, at, whole and not quoted)
            key, data = now, []
            utf8, delim, quoted, record, line = rows[0][3:]
            record -= 1  # the last that began
            at, whole, delim_b = line, not quoted, delim.encode()
        for r in rows:
            for piece in _pieces(r[2]):
                if not quoted and data:
                    add(data, record, at, whole)
                    data = []
                if not quoted:
                    record, at, whole = record + 1, line, True
                data.append(piece)
                line += 1
                if b'"' in piece:
                    quoted = quoted_after(piece, delim_b, quoted)
        if len(out) >= 5000:
            yield from flush()
    if key is not None and data:
        add(data, record, at, whole and not quoted)
    yield from flush()


def scan(spark: SparkSession, paths: str | list[str], ranges_sent: int | None = None) -> DataFrame:
    """(path, row_idx, line_no, cells, error) of all files: a row a record of delimited files and of the first usable sheet of workbooks, or one row with an error.

    Text that is no UTF-8 is read as Latin-1, a file at a time; a byte-order mark is left out. A file with a field beyond the csv module's limit is an
    error. Where a quoted field never ends, its last newline is kept or added. An empty file has no rows.
    """
    lines = text_lines(spark, paths)
    found = materialize(summaries(lines))
    coded = found.groupBy("path").agg(F.min("utf8").alias("coded"))
    plan = materialize(states(found).join(coded, "path").select("path", "start", "kind", F.col("coded").alias("coded"), "delim", "quoted", "record", F.col("line").alias("before")))
    mine = plan.filter("kind = 'csv'").drop("kind")
    shown = ["path", "start", "line", "coded", "delim", "quoted", "record", "before"]
    if plan.count() <= (BROADCAST_RANGES if ranges_sent is None else ranges_sent):
        told = lines.join(F.broadcast(mine), ["path", "start"]).select(*shown)  # lines keep their order
    else:
        told = lines.join(mine, ["path", "start"]).repartition("path", "start").sortWithinPartitions("path", "start", "seq").select(*shown)
    parsed = materialize(told.mapInArrow(_parse_ranges, PARSED))
    shared = parsed.filter("piece is not null")
    long = shared.groupBy("path", "record").agg(F.sum(F.length("piece")).alias("size")).withColumn("fits", F.col("size") <= LONGEST)
    parts = shared.join(long, ["path", "record"]).groupBy("path", "record").agg(F.min("line").alias("line"), F.first("fits").alias("fits"), F.array_sort(F.collect_list(F.when(F.col("fits"), F.struct("start", "piece")))).alias("parts"))
    files = plan.select("path", "coded", "delim").distinct()

    @F.udf("struct<cells:array<string>,error:string>")
    def join(parts, fits, utf8, delim, record):
        if not fits:
            return None, f"record of more than {LONGEST} bytes"
        rows, error = _parse(b"".join(bytes(p["piece"]) for p in parts), utf8, delim, record == 0)
        return (rows[0] if rows else [] if error is None else None), error

    met = parts.join(files, "path").withColumn("got", join("parts", "fits", "coded", "delim", "record")).select("path", "record", "line", "got.cells", "got.error")
    rows = parsed.filter("piece is null").select("path", "record", "line", "cells", "error").unionByName(met)
    bad = materialize(rows.filter("error is not null").groupBy("path").agg(F.min_by("error", "record").alias("error")))
    failing = bad.count()
    if 0 < failing <= BROADCAST_RANGES:
        rows = rows.join(F.broadcast(bad.select("path")), "path", "left_anti")
    elif failing:
        rows = rows.join(bad.select("path"), "path", "left_anti")
    good = rows.select("path", F.col("record").alias("row_idx"), F.col("line").alias("line_no"), "cells", F.lit(None).cast("string").alias("error"))
    failed = bad.select("path", F.lit(-1).cast("long").alias("row_idx"), F.lit(None).cast("long").alias("line_no"), F.lit(None).cast("array<string>").alias("cells"), "error")
    return good.unionByName(failed).unionByName(_workbooks(spark, plan))


def _workbooks(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """Files that are no text, each read whole by one task, as their formats need."""
    kinds = plan.filter("kind != 'csv'").select("path", "kind").distinct()
    found = [r["path"] for r in kinds.select("path").collect()]  # workbooks, a few megabytes each
    if not found:
        return spark.createDataFrame([], "path string, row_idx long, line_no long, cells array<string>, error string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_ = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string())
        for batch in batches:
            for path, content, kind in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    rows = [(path, i, i, [str(c) for c in r], None) for i, r in enumerate(rows_of(content, kind))]
                except ValueError as e:
                    rows = [(path, -1, None, None, str(e))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds_)], ["path", "row_idx", "line_no", "cells", "error"])

    whole = spark.read.format("binaryFile").load(found)
    whole = whole.select(whole.metadataColumn("_metadata")["file_path"].alias("path"), "content")
    return whole.join(kinds, "path").select("path", "content", "kind").mapInArrow(run, "path string, row_idx long, line_no long, cells array<string>, error string")
