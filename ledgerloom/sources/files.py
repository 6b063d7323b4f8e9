"""Files as rows of cells, and results as files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

ENCODINGS = ("utf-8-sig", "utf-8", "latin-1", "cp1252")


def list_files(spark: SparkSession, root: str, canonical: bool = False) -> DataFrame:
    """(path, content, borough, district, file) under root/<borough>/[<district>/]…; log, json and files that begin with
    a point or an underscore are left out, and so are those that begin with ``AMOD_`` unless ``canonical`` asks for them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    clean = root.rstrip("/").split("://")[-1].split(":")[-1]
    inner = F.split(F.regexp_replace(F.regexp_extract("path", f"{clean}/(.*)$", 1), "%20", " "), "/")
    out = files.withColumn("file", F.regexp_replace(name, "%20", " ")).withColumn("borough", F.replace(F.get(inner, F.lit(0)), F.lit("_"), F.lit(" "))).withColumn("district", F.when(F.size(inner) > 2, F.get(inner, F.lit(1))))
    return out.filter(~F.col("file").rlike(r"^(\.|_)" if canonical else r"^(AMOD_|\.|_)") & ~F.lower("file").rlike(r"\.(json|log)$"))


def sniff_format(content: Column, path: Column) -> Column:
    """xlsx, xls, pdf or csv by the first bytes, then by the extension."""
    head = F.hex(F.substring(content, 1, 8))
    low = F.lower(path)
    return (
        F.when(F.startswith(head, F.lit("504B0304")), "xlsx").when(F.startswith(head, F.lit("D0CF11E0")), "xls").when(F.startswith(head, F.lit("255044462D")), "pdf")
        .when(low.rlike(r"\.xlsx$"), "xlsx").when(low.rlike(r"\.xls$"), "xls").when(low.rlike(r"\.pdf$"), "pdf").otherwise("csv")
    )


def decode(data: bytes) -> str:
    """Text in the first encoding that fits."""
    for e in ENCODINGS:
        try:
            return data.decode(e)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


def delimiter(text: str) -> str:
    head = text[:8192]
    try:
        return csv.Sniffer().sniff(head, delimiters=",\t;|").delimiter
    except csv.Error:
        return "\t" if head.count("\t") > head.count(",") else ","


def rows_of(data: bytes, kind: str) -> list[list[str]]:
    """Rows of a delimited file or of the first usable sheet of a workbook; raises ValueError where it cannot be read."""
    if kind == "pdf":
        raise ValueError("PDF is not supported")
    if kind in ("xlsx", "xls"):
        try:
            import openpyxl
        except ImportError as e:
            raise ValueError("workbooks need openpyxl") from e
        for read_only in (True, False):
            try:
                book = openpyxl.load_workbook(io.BytesIO(data), read_only=read_only, data_only=True)
                for sheet in book.worksheets:
                    if not sheet.title.startswith("_") and "LTR Template" not in sheet.title:
                        return [["" if c is None else str(c).strip() for c in r] for r in sheet.iter_rows(values_only=True)]
            except Exception:  # noqa: BLE001, S112 - the next way to open it
                continue
        raise ValueError("workbook cannot be opened")
    text = decode(data)
    return list(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter(text)))


def read_rows(files: DataFrame) -> DataFrame:
    """Files (borough, file, path, content) -> (borough, file, row_idx, cells, error): a row a line, or one with an error."""
    small = files.select("borough", "file", "path", "content", sniff_format(F.col("content"), F.col("path")).alias("kind"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for b, name, data, kind in zip(f["borough"], f["file"], f["content"], f["kind"]):
                try:
                    rows = rows_of(bytes(data), kind)
                except (ValueError, csv.Error) as e:
                    yield pd.DataFrame({"borough": [b], "file": [name], "row_idx": [-1], "cells": [None], "error": [str(e)]})
                    continue
                for at in range(0, len(rows), 5000):
                    part = rows[at : at + 5000]
                    yield pd.DataFrame({"borough": b, "file": name, "row_idx": range(at, at + len(part)), "cells": part, "error": None})

    return small.mapInPandas(run, "borough string, file string, row_idx long, cells array<string>, error string")


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None, skip_bad: bool = False, **options) -> DataFrame:
    """CSV with a header, every column text, names trimmed, only the columns asked for; a byte-order mark is no part of a name."""
    df = spark.read.options(header=True, inferSchema=False, multiLine=True, escape='"', mode="DROPMALFORMED" if skip_bad else "PERMISSIVE", **options).csv(path)
    df = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.options(header=True, multiLine=True, escape='"').schema(schema).csv(path)


def header_and_first(rows: DataFrame) -> DataFrame:
    """(borough, file, header, first_row): first row, and the first row below it that is not blank, padded to its width."""
    from ..functions.text import strip

    solid = rows.filter(F.exists("cells", lambda c: strip(c) != ""))
    head = solid.groupBy("borough", "file").agg(F.min("row_idx").alias("_h"), F.min_by("cells", "row_idx").alias("header"))
    body = solid.join(head, ["borough", "file"]).filter(F.col("row_idx") > F.col("_h")).groupBy("borough", "file").agg(F.min_by("cells", "row_idx").alias("first_row"))
    width = F.size("header")
    return head.join(body, ["borough", "file"], "left").select("borough", "file", "header", F.slice(F.concat(F.coalesce("first_row", F.array().cast("array<string>")), F.array_repeat(F.lit(""), width)), F.lit(1), width).alias("first_row"))


def file_manifest(found: DataFrame, targets: DataFrame) -> DataFrame:
    """found(name, path, mtime, size) and targets(name): the newest copy of each and OK, DUPLICATE or MISSING."""
    best = found.groupBy("name").agg(F.max_by("path", F.struct("mtime", "path")).alias("canonical"), F.count(F.lit(1)).alias("copies"), F.max("mtime").alias("mtime"))
    out = targets.select("name").distinct().join(best, "name", "left")
    return out.select("name", "canonical", F.coalesce("copies", F.lit(0)).alias("copies"), F.when(F.col("copies").isNull(), "MISSING").when(F.col("copies") > 1, "DUPLICATE").otherwise("OK").alias("status"))


def inventory_metadata(inventory: DataFrame, files: DataFrame) -> DataFrame:
    """Inventory rows with what was found of their file; FILE NOT FOUND where nothing was."""
    return inventory.join(files, ["borough", "file"], "left").withColumn("status", F.when(F.col("header").isNull(), "FILE NOT FOUND").otherwise("OK"))


def only_new(listing: DataFrame, manifest: DataFrame, key: str = "url") -> DataFrame:
    """What a manifest does not have yet; repeated keys once."""
    return listing.join(manifest.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def output_name(path: str, suffix: str) -> str:
    """Path with a suffix before its extension."""
    stem, dot, ext = path.rpartition(".")
    return f"{stem}{suffix}.{ext}" if dot else f"{path}{suffix}"


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header. With ``bom`` the header cell of each file begins with a byte-order mark, as spreadsheets expect."""
    out = df.toDF(*[("﻿" if bom and i == 0 else "") + c for i, c in enumerate(df.columns)])
    out.write.mode("overwrite").options(header=True, encoding="UTF-8", escape='"').csv(path)


def write_lines(numbered: DataFrame, path: str) -> None:
    """JSON lines (file_no, line_no, line) as one directory a batch file."""
    numbered.repartition("file_no").sortWithinPartitions("file_no", "line_no").select("file_no", F.col("line").alias("value")).write.mode("overwrite").partitionBy("file_no").text(path)


def replace_partitions(df: DataFrame, path: str, key: str = "borough") -> None:
    """Write publishers' partitions, only those that df has; others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def newest(df: DataFrame, key: str, stamp: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(stamp)))).filter("_n = 1").drop("_n")


def job_status(spark: SparkSession, manifest: str) -> DataFrame:
    """Rows of the jobs in a job manifest; states without their prefix."""
    m = spark.read.option("multiLine", True).json(manifest).select("pipeline_run", "model", F.explode("jobs").alias("job"))
    return m.select("pipeline_run", "model", "job.*").withColumn("state", F.regexp_replace("state", "^JOB_STATE_", ""))
