"""The corpus that the queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.operators import discovery, fields, nested
from textlens.sources import files
from textlens.session import table

COLUMNS = ["designations", "definitions", "valueDomain", "stewardOrg", "registrationState", "views", "archived", "created"]


def items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """cde_item in its latest versions, each record once."""
    wanted = list(columns or COLUMNS)
    df = nested.latest_version(table(spark, sf_dir, "cde_item").select("tinyId", "x__v", "loaded_at", *wanted), "tinyId", "x__v")
    first = df.groupBy("tinyId").agg(F.min_by(F.struct(*wanted), F.coalesce("loaded_at", F.lit("9999-01-01").cast("timestamp"))).alias("r"))
    return first.select("tinyId", *[F.col(f"r.{c}").alias(c) for c in wanted])


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.field_texts(items(spark, sf_dir, "designations", "definitions", "valueDomain"))


def pattern_lists(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The pattern tables as lists of ``stripping.strip_lists``: substitute, inst_full, inst_sub, phrase."""
    none, empty = F.array().cast("array<string>"), F.lit("")
    sub = table(spark, sf_dir, "substitute_patterns").where("pattern is not null").select(F.col("row_id").alias("file_ord"), F.col("pattern").alias("phrase"), "replace_with", files.ids(F.col("tinyIds")).alias("ids"))
    inst = table(spark, sf_dir, "inst_full_patterns").where("pattern is not null").select(F.col("row_id").alias("file_ord"), F.col("pattern").alias("phrase"), empty.alias("replace_with"), files.ids(F.col("tinyIds")).alias("ids"))
    parts = discovery.splits(inst.select(F.col("phrase").alias("name")).distinct()).where("sub is not null").select(F.col("name").alias("phrase"), "sub")
    part = inst.join(parts, "phrase").select("file_ord", F.col("sub").alias("phrase"), "replace_with", "ids")
    phrases = table(spark, sf_dir, "phrases").where("text is not null").select(F.coalesce("phrase_id", empty).alias("id"), F.col("text").alias("phrase"), F.filter(F.coalesce("distinct_tinyids", none), lambda x: x.isNotNull()).alias("ids"))
    phrases = phrases.groupBy("id", "phrase").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"), F.min(F.size("ids")).alias("least"))
    universal = F.when(F.col("least") > 0, F.col("ids")).otherwise(none)  # a row without ids is for all records
    phrase = phrases.select(F.concat_ws("|", "id", "phrase").alias("file_ord"), "phrase", empty.alias("replace_with"), universal.alias("ids"))
    return {"substitute": sub, "inst_full": inst, "inst_sub": part, "phrase": phrase}


def with_rules(patterns: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The list and universal rules (phrase, replacement) besides."""
    kind = dict(patterns.dtypes)["file_ord"]
    ord_ = [(-1 - i if kind == "bigint" else f"rule {i}", p, r) for i, (p, r) in enumerate(rules)]
    more = patterns.sparkSession.createDataFrame(ord_, f"file_ord {kind}, phrase string, replace_with string")
    return patterns.unionByName(more.withColumn("ids", F.array().cast("array<string>")))


SQL_ITEMS = """items AS (
  SELECT * FROM cde_item WHERE tinyId IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tinyId ORDER BY x__v DESC NULLS LAST, loaded_at) = 1)"""

SQL_TEXTS = (
    SQL_ITEMS
    + """,
raw_texts AS (
  SELECT tinyId, 'designation' AS field, i - 1 AS idx, 'designations[' || (i - 1) || '].designation' AS field_path, designations[i].designation AS text FROM items, unnest(range(1, len(designations) + 1)) t(i)
  UNION ALL SELECT tinyId, 'definition', i - 1, 'definitions[' || (i - 1) || '].definition', definitions[i].definition FROM items, unnest(range(1, len(definitions) + 1)) t(i)
  UNION ALL SELECT tinyId, 'valueMeaningName', i - 1, 'valueDomain.permissibleValues[' || (i - 1) || '].valueMeaningName', valueDomain.permissibleValues[i].valueMeaningName FROM items, unnest(range(1, len(valueDomain.permissibleValues) + 1)) t(i)
  UNION ALL SELECT tinyId, 'valueMeaningDefinition', i - 1, 'valueDomain.permissibleValues[' || (i - 1) || '].valueMeaningDefinition', valueDomain.permissibleValues[i].valueMeaningDefinition FROM items, unnest(range(1, len(valueDomain.permissibleValues) + 1)) t(i)),
texts AS (SELECT * FROM raw_texts WHERE text IS NOT NULL AND trim(text) <> '')"""
)


def with_texts(body: str) -> str:
    return f"WITH {SQL_TEXTS}{body if body.lstrip().startswith(',') else ' ' + body}"


def with_items(body: str) -> str:
    return f"WITH {SQL_ITEMS}{body if body.lstrip().startswith(',') else ' ' + body}"


def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tinyId, field, field_path, text): the corpus's texts and the texts in which instruments were found."""
    m = table(spark, sf_dir, "instrument_match").where("full_match is not null and tinyId is not null")
    return texts(spark, sf_dir).select("tinyId", "field", "field_path", "text").unionByName(m.select("tinyId", F.lit("definition").alias("field"), "field_path", F.col("full_match").alias("text")))


SQL_EVERYTHING = ", every AS (SELECT tinyId, field, field_path, text FROM texts UNION ALL SELECT tinyId, 'definition', field_path, full_match FROM instrument_match WHERE full_match IS NOT NULL AND tinyId IS NOT NULL)"


def with_everything(body: str) -> str:
    return with_texts(SQL_EVERYTHING + (body if body.lstrip().startswith(",") else " " + body))
