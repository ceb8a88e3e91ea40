"""Counts over nested fields, whole-text duplicates, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from textlens.functions import paths, text as tx

EMPTY = ("", "null", "[]")


def leaf_rows(df: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """(keep, path, name, value) of every leaf below columns; name is the last part of the path."""
    rows = df.select(*keep, F.explode(paths.leaves(df, columns)).alias("l")).select(*keep, "l.path", "l.value")
    return rows.withColumn("name", F.element_at(F.split("path", r"\."), -1))


def wanted(path: Column, name: Column, fields: list[str]) -> Column:
    """Exact path, base name, or a glob where * stands for anything."""
    tests = [path.isin(*fields), name.isin(*fields)]
    tests += [path.rlike("^" + f.replace(".", r"\.").replace("*", ".*") + "$") for f in fields if "*" in f]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def matches(value: Column, how: str, pattern: str | None = None) -> Column:
    empty = value.isNull() | value.isin(*EMPTY)
    if how == "non_null":
        return ~empty
    if how == "null":
        return empty
    blank = value.isNull() | value.isin("", "[]")
    return ~blank & (value == pattern if how == "fixed" else value.rlike(pattern))


def count_fields(leaf: DataFrame, fields: list[str], how: str = "non_null", pattern: str | None = None, group: str | None = None, with_type: bool = False) -> DataFrame:
    """(field, [type], group, n): matching leaves by field and group, from ``leaf_rows`` rows."""
    rows = leaf.where(wanted(F.col("path"), F.col("name"), fields) & matches(F.col("value"), how, pattern))
    key = F.when(F.col("path").isin(*fields), F.col("path")).otherwise(F.col("name"))
    by = [key.alias("field"), (F.coalesce(F.col(group).cast("string"), F.lit("<unknown>")) if group else F.lit("<global>")).alias("group")]
    if with_type:
        by.insert(1, tx.value_type(F.col("value")).alias("type"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def group_values(df: DataFrame, key: str, by: str, how: str = "top", columns: list[str] | None = None) -> DataFrame:
    """(key, group): a record's group value: a top-level field, the last leaf whose path contains ``by``, or the last leaf named so."""
    if how == "top":
        return df.select(key, F.coalesce(F.col(by).cast("string"), F.lit("<unknown>")).alias("group"))
    leaf = paths.leaves(df, columns)
    fits = (lambda x: F.contains(x["path"], F.lit(by))) if how == "path" else (lambda x: F.element_at(F.split(x["path"], r"\."), -1) == by)
    return df.select(key, F.coalesce(F.get(F.reverse(F.filter(leaf, lambda x: fits(x) & x["value"].isNotNull())), F.lit(0))["value"], F.lit("<unknown>")).alias("group"))


def duplicate_texts(texts: DataFrame, key: str = "tinyId", least_ids: int = 2) -> DataFrame:
    """(text_hash, n_occurrences, n_ids, sample_text): texts equal up to white space in several records."""
    norm = F.trim(F.regexp_replace("text", r"\s+", " "))
    return (
        texts.select(key, norm.alias("t")).groupBy(F.sha2("t", 256).alias("text_hash"))
        .agg(F.count("*").alias("n_occurrences"), F.countDistinct(key).alias("n_ids"), F.min("t").alias("sample_text"))
        .where(F.col("n_ids") >= least_ids)
    )


def vocabulary(texts: DataFrame, least: int = 2, most: int = 10_500) -> DataFrame:
    """(token, n, rank): tokens by frequency, then alphabet; ranks from 1, rarer ones and those past ``most`` get 0.

    Ranks need one order over the vocabulary (not the corpus); the head is cut by a top-k first.
    """
    counts = texts.select(F.explode(tx.tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    head = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(most)
    ranked = head.select("token", F.row_number().over(Window.orderBy(F.desc("n"), "token")).alias("rank"))
    return counts.join(ranked, "token", "left").select("token", "n", F.coalesce("rank", F.lit(0)).alias("rank"))


def fingerprint(ids: DataFrame, key: str) -> DataFrame:
    """(n_ids, fingerprint): order-free digest of the distinct ids.

    A sum of 60-bit hash parts in two independent halves instead of one sorted string: it combines
    map-side and never gathers the ids.
    """
    h = F.sha2(F.col("id"), 256)
    part = lambda a: F.sum(F.conv(F.substring(h, a, 15), 16, 10).cast("decimal(38,0)"))
    return ids.select(F.col(key).alias("id")).where("id is not null").distinct().agg(F.count("*").alias("n_ids"), part(1).cast("string").alias("sum_a"), part(16).cast("string").alias("sum_b"))
