"""The cumulative ledger of patterns, supplementary sections, promotion, suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Words that tell what a pattern is about, by section, in their order (fixed values).
SECTIONS = {
    "instruments": "scale|index|inventory|questionnaire|survey|interview|checklist|battery|schedule|form|test",
    "temporal": "past|previous|last|since|baseline|day|days|week|weeks|month|months|year|years|visit",
    "studies": "study|trial|cohort|registry",
}


def update(ledger: DataFrame, found: DataFrame, round_: int) -> DataFrame:
    """(pattern, ids, source, first_round, last_round, status) with the found rows (pattern, ids, source) taken in.

    Ids unite; source and status of a known pattern stay. A pattern found again is ``seen``, a new one ``new``; one not
    found this time keeps its status.
    """
    new = found.groupBy("pattern").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("ids", F.array().cast("array<string>")))))).alias("_ids"), F.min("source").alias("_source"))
    j = ledger.join(new, "pattern", "full")
    none = F.array().cast("array<string>")
    known, again = F.col("first_round").isNotNull(), F.col("_ids").isNotNull()
    return j.select(
        "pattern", F.array_sort(F.array_union(F.coalesce("ids", none), F.coalesce("_ids", none))).alias("ids"), F.coalesce("source", "_source").alias("source"),
        F.coalesce("first_round", F.lit(round_)).alias("first_round"), F.when(again, F.lit(round_)).otherwise(F.col("last_round")).alias("last_round"),
        F.when(~known, "new").when(again & (F.col("status") == "new"), "seen").otherwise(F.col("status")).alias("status"),
    )


def section(pattern: Column) -> Column:
    """The section whose words a pattern holds first in the order of SECTIONS, else ``other``."""
    out = F.lit("other")
    for name, words in reversed(SECTIONS.items()):
        out = F.when(F.lower(pattern).rlike(rf"\b(?:{words})\b"), name).otherwise(out)
    return out


def to_sections(harvested: DataFrame) -> DataFrame:
    """(section, name, pattern): new candidates (phrase, status) by section, named by their slug of at most five words."""
    slug = F.array_join(F.slice(F.filter(F.split(F.lower("phrase"), "[^a-z0-9]+"), lambda w: w != ""), 1, 5), "_")
    return harvested.where("status = 'new_candidate'").select(section(F.col("phrase")).alias("section"), slug.alias("name"), F.col("phrase").alias("pattern"))


def add(sections: DataFrame, curated: DataFrame) -> DataFrame:
    """sections (section, name, pattern) and those curated rows whose pattern the section has not yet, case aside."""
    low = lambda df: df.withColumn("_l", F.lower("pattern"))
    rows = low(curated.select("section", "name", "pattern")).dropDuplicates(["section", "_l"])
    new = rows.join(low(sections).select("section", "_l").distinct(), ["section", "_l"], "left_anti").drop("_l")
    return sections.select("section", "name", "pattern").unionByName(new)


def promote(local: DataFrame, general: DataFrame, least_ids: int = 5) -> tuple[DataFrame, DataFrame]:
    """(general, local) after patterns with ``least_ids`` records or more moved from the local to the general list (pattern, n_ids)."""
    up = local.where(F.col("n_ids") >= least_ids)
    both = general.select("pattern", "n_ids").unionByName(up.select("pattern", "n_ids")).groupBy("pattern").agg(F.max("n_ids").alias("n_ids"))
    return both, local.where(F.coalesce("n_ids", F.lit(0)) < least_ids).select("pattern", "n_ids")


def suggestions(residual: DataFrame, least: int = 2) -> DataFrame:
    """(section, entry): residual contexts (context, n_ids) seen in ``least`` records or more as lines for a configuration file."""
    line = F.concat(F.lit("- pattern: '"), F.replace(F.col("context"), F.lit("'"), F.lit("''")), F.lit("'  # records: "), F.col("n_ids").cast("string"))
    return residual.where(F.col("n_ids") >= least).select(section(F.col("context")).alias("section"), line.alias("entry"))
