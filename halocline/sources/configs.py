"""Run configurations: scanned as text, reported as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed layout of the report.
HEADER = (
    "# Experiment Overview",
    "",
    "Active experiment configs live under `configs/experiments/` and are run from the project root.",
    "",
    "| Experiment | Run | Model | Validation | Cache | Output | Config |",
    "| --- | --- | --- | --- | --- | --- | --- |",
)
FOOTER = (
    "",
    "Archived configs under `configs/archive/` are intentionally excluded from this table.",
)
# A "model:" line and the blank or space-indented lines after it.
MODEL_BLOCK = r"(?m)^model:[^\n]*((?:\n(?: [^\n]*)?(?=\n|\z))*)"


def read_configs(spark: SparkSession, pattern: str, root: str = "") -> DataFrame:
    """(path, text), one row per file; ``root`` is cut off the paths."""
    path = F.col("_metadata.file_path")
    short = F.regexp_replace(path, r"^file:/*", "/")
    if root:
        short = F.replace(short, F.lit(root.rstrip("/") + "/"), F.lit(""))
    return spark.read.text(pattern, wholetext=True).select(short.alias("path"), F.col("value").alias("text"))


def _clean(raw: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(raw, r"^\s+|\s+$", ""), r"""^['"]+|['"]+$""", "")


def _last(text: Column, pattern: str) -> Column:
    """The last match wins; '' where there is none."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return _clean(F.coalesce(F.get(hits, F.size(hits) - 1), F.lit("")))


def parse_configs(df: DataFrame) -> DataFrame:
    """Flat fields of each configuration, line by line, without a YAML parser."""
    text = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))
    models = F.array_join(F.regexp_extract_all(text, F.lit(MODEL_BLOCK), F.lit(1)), "\n")
    names = F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]+- name:[ \t]*(.+)$"), F.lit(1))
    return df.select(
        "path",
        _last(text, r"(?m)^experiment_name:[ \t]*(.+)$").alias("experiment_name"),
        _last(text, r"(?m)^run_name:[ \t]*(.+)$").alias("run_name"),
        _last(models, r"(?m)^[ \t]+name:[ \t]*(.+)$").alias("model_name"),
        F.array_join(F.transform(names, _clean), ", ").alias("validation"),
        _last(text, r"(?m)^[ \t]+cache_namespace:[ \t]*(.+)$").alias("cache_namespace"),
        _last(text, r"(?m)^[ \t]+run_dir:[ \t]*(.+)$").alias("run_dir"),
    )


def overview_rows(parsed: DataFrame) -> DataFrame:
    """(path, line): the table row of each configuration."""
    line = F.format_string(
        "| %s | %s | %s | %s | %s | `%s` | `%s` |", "experiment_name", "run_name", "model_name",
        "validation", "cache_namespace", "run_dir", "path")
    return parsed.select("path", line.alias("line"))


def overview(parsed: DataFrame) -> DataFrame:
    """The whole report as ordered lines, ready for a text sink."""
    spark = parsed.sparkSession
    fixed = [(0, f"{i:02d}", t) for i, t in enumerate(HEADER)] + [
        (2, f"{i:02d}", t) for i, t in enumerate(FOOTER)]
    frame = spark.createDataFrame(fixed, "part int, at string, value string")
    body = overview_rows(parsed).select(
        F.lit(1).alias("part"), F.col("path").alias("at"), F.col("line").alias("value"))
    return frame.unionByName(body).orderBy("part", "at").select("value")
