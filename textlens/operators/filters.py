"""Filters, semi- and anti-joins on records and their texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def subset_by_ids(df: DataFrame, ids: DataFrame, key: str, exclude: bool = False) -> DataFrame:
    """Rows whose key is (not) among ids (column ``id``); rows with a null key are left out either way."""
    wanted = ids.select(F.col("id").alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.where(F.col(key).isNotNull()).join(wanted, key, "left_anti" if exclude else "left_semi")


def text_hit(text: Column, value: str, regex: bool = False, case_sensitive: bool = False) -> Column:
    if regex:
        return text.rlike(value if case_sensitive else f"(?iu){value}")
    return F.contains(text, F.lit(value)) if case_sensitive else F.contains(F.lower(text), F.lit(value.lower()))


def subset_by_text(texts: DataFrame, key: str, value: str, exclude: bool = False, **how) -> DataFrame:
    """Keys of records with (without) a text that holds value."""
    hits = texts.groupBy(key).agg(F.max(text_hit(F.col("text"), value, **how)).alias("hit"))
    return hits.where(~F.col("hit") if exclude else F.col("hit")).select(key)


def first_pattern(texts: DataFrame, key: str, patterns: list[tuple[str, str]], exclude: bool = False) -> DataFrame:
    """(key, pattern, label, text): the first pattern in order that matches, in the first text in order.

    patterns: (regex, label), at most a few hundred as in a pattern file; broken ones are skipped. They
    become one expression, so the texts are read once and nothing is exploded. With exclude: (key) of the records in
    which none matches.
    """
    good = []
    for p, label in patterns:
        try:
            re.compile(p)
        except re.error:
            continue
        good.append((p, label))
    tests = [F.when(F.col("text").rlike(f"(?iu){p}"), F.struct(F.lit(i).alias("ord"), "field_path", "text", F.lit(p).alias("pattern"), F.lit(label).alias("label"))) for i, (p, label) in enumerate(good)]
    if exclude:
        return texts.groupBy(key).agg(F.max(F.coalesce(*tests, F.lit(None)).isNotNull()).alias("hit")).where("not hit").select(key)
    best = texts.select(key, F.coalesce(*tests).alias("m")).where("m is not null").groupBy(key).agg(F.min("m").alias("m"))
    return best.select(key, "m.pattern", "m.label", "m.text")


class Logic:
    """Boolean expressions over field names: names, and, or, not, parentheses. Nothing else is accepted."""

    _TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z_][\w.]*)")

    def __init__(self, expression: str):
        self.tokens, at = [], 0
        while expression[at:].strip():
            m = self._TOKEN.match(expression, at)
            if not m:
                raise ValueError(f"not a logic expression: {expression!r}")
            self.tokens.append(m[1])
            at = m.end()

    def column(self, flags: dict[str, Column]) -> Column:
        """The expression over flags; a missing name makes it false, as an error does in the contract."""
        todo = list(self.tokens)
        if any(t not in flags for t in todo if t not in ("(", ")", "and", "or", "not")):
            return F.lit(False)

        def either() -> Column:
            c = both()
            while todo and todo[0] == "or":
                todo.pop(0)
                c = c | both()
            return c

        def both() -> Column:
            c = one()
            while todo and todo[0] == "and":
                todo.pop(0)
                c = c & one()
            return c

        def one() -> Column:
            if not todo:
                raise ValueError("expression ends early")
            t = todo.pop(0)
            if t == "not":
                return ~one()
            if t == "(":
                c = either()
                if not todo or todo.pop(0) != ")":
                    raise ValueError("missing )")
                return c
            if t in (")", "and", "or"):
                raise ValueError(f"unexpected {t}")
            return flags[t]

        c = either()
        if todo:
            raise ValueError(f"unexpected {todo[0]}")
        return c


def pattern_filters(patterns: DataFrame, excluded: DataFrame | None = None, least_words: int = 0, least_fields: int = 0, no_substrings: bool = False) -> DataFrame:
    """patterns (pattern, and n_fields if ``least_fields`` is set) that pass: not in the list (pattern, case aside), long enough, seen in
    enough fields, and, with no_substrings, within no longer pattern that passes."""
    from textlens.operators.matching import inside

    out = patterns.where(F.size(F.filter(F.split("pattern", r"\s+"), lambda w: w != "")) >= least_words)
    if least_fields:
        out = out.where(F.col("n_fields") >= least_fields)
    if excluded is not None:
        out = out.withColumn("_l", F.lower("pattern")).join(excluded.select(F.lower("pattern").alias("_l")).distinct(), "_l", "left_anti").drop("_l")
    if no_substrings:
        out = out.join(inside(out, out).select(F.col("short").alias("pattern")).distinct(), "pattern", "left_anti")
    return out
