"""Batch requests for a language model, as JSON lines, and its answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..plans.ranking import global_rank


def record_block(df: DataFrame, skip: tuple[str, ...] = ("rq_id",), strip_codes: bool = True) -> Column:
    """``name: value`` lines of the columns that are not blank."""
    lines = []
    for f in df.schema:
        if f.name not in skip:
            v = T.blank_to_null(F.col(f.name).cast("string"))
            v = T.strip_code_prefix(v) if strip_codes and f.dataType.simpleString() == "string" else v
            lines.append(F.concat(F.lit(f"{f.name}: "), v))  # null where v is: v is worked out once
    return F.concat_ws("\n", *lines)


def request(key: Column, prompt: Column, schema: Column | None = None, system: str | None = None, temperature: float = 0.0, max_tokens: int = 256) -> Column:
    """One request as a JSON line; schema and system instruction are left out where absent."""
    part = lambda t: F.array(F.struct(t.alias("text")))
    config = F.struct(F.lit(temperature).alias("temperature"), F.lit(1).alias("topK"), F.lit(1.0).alias("topP"), F.lit(max_tokens).alias("maxOutputTokens"), F.lit(1).alias("candidateCount"), F.lit("application/json").alias("responseMimeType"), (schema if schema is not None else F.lit(None).cast("string")).alias("responseSchema"))
    body = [F.array(F.struct(F.lit("user").alias("role"), part(prompt).alias("parts"))).alias("contents")]
    if system is not None:
        body.append(F.struct(part(F.lit(system)).alias("parts")).alias("systemInstruction"))
    return F.to_json(F.struct(key.alias("key"), F.struct(*body, config.alias("generationConfig")).alias("request")))


def enum_schema(field: str, values: Column, *others: str) -> Column:
    """Response schema whose first field is one of values (a column, so each row can have its own)."""
    text = F.struct(F.lit("STRING").alias("type"))
    fields = F.struct(F.struct(F.lit("STRING").alias("type"), values.alias("enum")).alias(field), *[text.alias(o) for o in others])
    return F.struct(F.lit("OBJECT").alias("type"), fields.alias("properties"), F.array(*[F.lit(x) for x in (field, *others)]).alias("required"))


def number_files(lines: DataFrame, order: list[Column], size: int = 10_000, stem: str = "batch") -> DataFrame:
    """+ line number, file number and file name; one file has no number in its name."""
    name = F.lit(f"{stem}.jsonl") if lines.count() <= size else F.concat(F.lit(f"{stem}_"), F.col("file_no"), F.lit(".jsonl"))
    return global_rank(lines, order, "line_no").withColumn("file_no", F.expr(f"(line_no - 1) div {size} + 1")).withColumn("file_name", name)


def taxonomy_requests(base: DataFrame, system: str | None = None, size: int = 10_000, in_scope_only: bool = False) -> DataFrame:
    """Rows with any key text -> (line_no, file_no, file_name, key, line)."""
    df = base.filter("procurement_scope = 'IN_SCOPE'") if in_scope_only else base
    keyed = df.select("rq_id", *[c for c in ("department", "expense_type", "service_area", "supplier_category", "supplier_clean") if c in df.columns])
    block = record_block(keyed)
    told = reduce(lambda a, b: a | b, [T.blank_to_null(F.col(c).cast("string")).isNotNull() for c in keyed.columns[1:]])  # so the block is not empty
    numbered = number_files(keyed.filter(told).withColumn("_n", F.regexp_extract("rq_id", r"(\d+)$", 1).cast("long")), [F.col("_n"), F.col("rq_id")], size)
    # lines are written after the numbering, which so moves keys alone
    return numbered.select(F.col("rq_id").alias("key"), request(F.col("rq_id"), block, None, system).alias("line"), "line_no", "file_no", "file_name")


def surrogate_ids(df: DataFrame, prefix: str, order: list[Column], name: str = "supplier_id") -> DataFrame:
    return global_rank(df, order, "_n").withColumn(name, F.concat(F.lit(prefix), F.col("_n"))).drop("_n")


def type_requests(context: DataFrame, subtypes: list[str], size: int = 10_000) -> DataFrame:
    """Suppliers with an optional context sentence -> numbered requests and their keys (supplier_id, supplier_clean)."""
    ids = surrogate_ids(context, "SUP_", [F.col("total_spend").desc_nulls_last(), F.col("supplier_clean")])
    prompt = F.concat_ws("\n", F.concat(F.lit("Supplier: "), F.col("supplier_clean")), F.when(F.col("context_descriptor").isNotNull(), F.concat(F.lit("Context: "), F.col("context_descriptor"))))
    schema = enum_schema("BUSINESS_SUBTYPE", F.array(*[F.lit(s) for s in subtypes]), "STATUS")
    lines = ids.select(F.col("supplier_id").alias("key"), "supplier_clean", request(F.col("supplier_id"), prompt, schema).alias("line"))
    return number_files(lines, [F.regexp_extract("key", r"(\d+)$", 1).cast("long")], size)


def choice_requests(candidates: DataFrame, size: int = 10_000) -> DataFrame:
    """Candidates (supplier_clean, rank, company_number, company_name, status, town) -> a request a supplier whose answer is
    one of its own candidates' numbers or NONE. Candidates are at most k a supplier."""
    bits = F.transform(F.array_sort(F.collect_list(F.struct("rank", "company_number", "company_name", "status", "town"))), lambda c: c)
    per = candidates.filter("company_number is not null").groupBy("supplier_clean").agg(bits.alias("c"))
    ids = surrogate_ids(per, "SUPCH_", [F.col("supplier_clean")])
    text = F.array_join(F.transform("c", lambda c, i: F.concat((i + 1).cast("string"), F.lit(". "), F.concat_ws(" | ", c["company_number"], c["company_name"], c["status"], c["town"]))), "\n")
    schema = enum_schema("company_number", F.concat(F.transform("c", lambda c: c["company_number"]), F.array(F.lit("NONE"))), "confidence")
    prompt = F.concat(F.lit("Supplier: "), F.col("supplier_clean"), F.lit("\nCandidates:\n"), text)
    lines = ids.select(F.col("supplier_id").alias("key"), "supplier_clean", F.size("c").alias("n_candidates"), request(F.col("supplier_id"), prompt, schema).alias("line"))
    return number_files(lines, [F.regexp_extract("key", r"(\d+)$", 1).cast("long")], size)


RESPONSE = "key string, custom_id string, id string, request struct<key: string>, response struct<candidates: array<struct<content: struct<parts: array<struct<text: string>>>>>>"


def parse_answers(lines: DataFrame, fields: list[str], column: str = "value") -> DataFrame:
    """JSON lines -> key, the fields of the answer (the first part with text, JSON itself), and error: null where all is well.
    Bad lines and bad answers are rows with an error, not failures."""
    r = F.from_json(F.col(column), RESPONSE)
    out = lines.withColumn("_r", r)
    parts = F.flatten(F.transform(F.coalesce("_r.response.candidates", F.array().cast("array<struct<content:struct<parts:array<struct<text:string>>>>>")), lambda c: F.coalesce(c["content"]["parts"], F.array().cast("array<struct<text:string>>"))))
    text = F.get(F.filter(parts, lambda p: p["text"].isNotNull()), F.lit(0))["text"]
    out = out.withColumn("key", F.coalesce("_r.key", "_r.custom_id", "_r.id", "_r.request.key")).withColumn("_text", text)
    out = out.withColumn("_a", F.from_json("_text", ", ".join(f"`{f}` string" for f in fields)))
    empty = F.lit(True)
    for f in fields:
        empty = empty & F.col(f"_a.{f}").isNull()
    error = F.when(F.col("key").isNull(), "no_key").when(F.col("_text").isNull(), "no_text").when(empty, "bad_json")
    return out.withColumn("error", error).select(*[c for c in lines.columns if c != column], "key", *[F.col(f"_a.{f}").alias(f) for f in fields], "error")


def answer_summary(answers: DataFrame, status: str, value: str) -> DataFrame:
    """Answers by status, errors, and distinct values."""
    return answers.groupBy(F.coalesce("error", status, F.lit("(none)")).alias("status")).agg(F.count(F.lit(1)).alias("answers"), F.countDistinct(value).alias("distinct_values"))
