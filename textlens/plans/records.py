"""Queries on nested records and packed cells (problems 2 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.operators import nested, packed
from textlens.plans.corpus import with_texts
from textlens.session import table

NESTED = ["designations", "definitions", "valueDomain"]


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cde_item in its latest versions and the records of cde_raw, in one shape."""
    items = nested.latest_version(table(spark, sf_dir, "cde_item").select("tinyId", "x__v", *NESTED), "tinyId", "x__v")
    raw = nested.parse_records(table(spark, sf_dir, "cde_raw").select("payload")).where("tinyId is not null")
    return items.select("tinyId", *NESTED).unionByName(raw.select("tinyId", *NESTED))


def field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tinyId, field_path, text) through the shredded tables."""
    return shredded_texts(nested.shred(all_records(spark, sf_dir), ["tinyId"], NESTED))


def shredded_texts(s: nested.Shredded) -> DataFrame:
    parts = [
        nested.field_values(s, ["tinyId"], ["designations"], ["designation"]),
        nested.field_values(s, ["tinyId"], ["definitions"], ["definition"]),
        nested.field_values(s, ["tinyId"], ["valueDomain", "permissibleValues"], ["valueMeaningName", "valueMeaningDefinition"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_texts(spark, sf_dir).select("tinyId", "field_path").distinct()


def p2_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each kind of object occurs, and how many distinct ones are stored."""
    s = nested.shred(all_records(spark, sf_dir), ["tinyId"], NESTED)
    return s.objects.groupBy("kind").agg(F.count("*").alias("n_objects"))


def known_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole values that are known to hold separators: lemmas of the variants, texts of the phrases."""
    lemmas = table(spark, sf_dir, "verbatim_variants").select(F.col("lemma").alias("value"))
    return lemmas.unionByName(table(spark, sf_dir, "phrases").select(F.col("text").alias("value")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ids are single words: separators always part them, no dictionary can protect one
    parts = [packed.split_packed(table(spark, sf_dir, name), "row_id", "tinyIds", None, words=True).withColumn("src", F.lit(name)) for name in ("substitute_patterns", "inst_full_patterns")]
    parts.append(packed.split_packed(table(spark, sf_dir, "verbatim_variants"), "row_id", "variants", known_values(spark, sf_dir)).withColumn("src", F.lit("verbatim_variants")))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("src", "row_id", "pos", "item").distinct()


def p2_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tinyId, field_path, text) of the shredded records of cde_item alone, which SQL can tell as well."""
    s = nested.shred(nested.latest_version(table(spark, sf_dir, "cde_item").select("tinyId", "x__v", *NESTED), "tinyId", "x__v"), ["tinyId"], NESTED)
    return shredded_texts(s).distinct()


QUERIES = {"p2_found": p2_found, "p2_items": p2_items, "p2_objects": p2_objects, "p4_found": p4_found}
_SPACE = r"regexp_matches(text, '[^\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{0085}\x{000B}]')"
ORACLES = {"p2_items": with_texts("SELECT DISTINCT tinyId, field_path, text FROM raw_texts WHERE text IS NOT NULL AND " + _SPACE)}
