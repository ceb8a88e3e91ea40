"""Workflows: named steps of DataFrame functions with variables, conditions, skips and checkpoints.

Steps stay lazy; only a step marked ``materialise`` is written (columnar, shared folder) so that what
follows does not compute it again.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from textlens.session import written

_VAR = re.compile(r"\$\{([^{}:]+)(?::-((?:[^{}]|\{[^{}]*\})*))?\}")


def resolve(value, variables: dict, passes: int = 3):
    """``${NAME}`` and ``${NAME:-default}`` in texts, lists and dicts; the environment is asked last.

    Defaults may hold variables; chains deeper than ``passes`` stay as they are, unknown names without a
    default too.
    """
    if isinstance(value, dict):
        return {k: resolve(v, variables, passes) for k, v in value.items()}
    if isinstance(value, list):
        return [resolve(v, variables, passes) for v in value]
    if not isinstance(value, str):
        return value
    for _ in range(passes):
        new = _VAR.sub(lambda m: str(variables[m[1]]) if m[1] in variables else os.environ.get(m[1], m[2] if m[2] is not None else m[0]), value)
        if new == value:
            break
        value = new
    return value


@dataclass
class Step:
    name: str
    run: Callable[[SparkSession, dict[str, DataFrame], dict], DataFrame]
    condition: str | None = None
    skip_if_file: str | None = None
    checkpoint: bool = False
    materialise: bool = False


@dataclass
class Workflow:
    name: str
    steps: list[Step]
    variables: dict = field(default_factory=dict)

    def _true(self, text: str | None, variables: dict) -> bool:
        return text is None or str(resolve(text, variables)).strip().lower() not in ("", "0", "false", "no", "none") and "${" not in str(resolve(text, variables))

    def run(self, spark: SparkSession, tables: dict[str, DataFrame], variables: dict | None = None, start: str | None = None, only: list[str] | None = None, dry_run: bool = False, state: str | None = None) -> dict:
        """Steps in order; returns {"tables", "status"}. A checkpoint step stops the run until it is resumed with ``start``."""
        known = [s.name for s in self.steps]
        for n in [start, *(only or [])]:
            if n is not None and n not in known:
                raise ValueError(f"no step {n}; there are {known}")
        values, tables, status = {**self.variables, **(variables or {})}, dict(tables), {}
        begun = start is None
        for s in self.steps:
            begun = begun or s.name == start
            if not begun or (only and s.name not in only):
                status[s.name] = "not selected"
            elif not self._true(s.condition, values):
                status[s.name] = "condition false"
            elif s.skip_if_file and os.path.exists(str(resolve(s.skip_if_file, values))):
                status[s.name] = "file exists"
            elif dry_run:
                status[s.name] = "would run"
            else:
                out = s.run(spark, tables, values)
                tables[s.name] = written(out, s.name) if s.materialise or s.checkpoint else out
                status[s.name] = "completed"
                if s.checkpoint:
                    status[s.name] = "checkpoint"
                    break
        if state:
            with open(state, "w", encoding="utf-8") as f:
                json.dump({"workflow": self.name, "status": status}, f)
        return {"tables": tables, "status": status}


def production_strip(lists: dict[str, DataFrame], seeds: list[str]) -> Workflow:
    """texts -> substitution -> expanded temporal seeds -> seven variants -> clean-up -> quality report; and embedding texts.

    lists: substitute, inst_full, inst_sub, phrase as ``stripping.strip_lists`` takes them: thousands of universal and
    scoped patterns. Every variant sees scoped patterns in each of its branches. Tables: ``clean`` (tinyId, field_path,
    variant, text), ``report``, ``embed`` (tinyId, variant, embed_text).
    """
    from pyspark.sql import functions as F

    from textlens.operators import matching, patterns, stripping

    def substitute(spark, t, v):
        out = stripping.strip_lists(t["texts"], {"substitute": lists["substitute"]}, {"stripped": ("substitute",)})
        return out.drop("text").withColumnRenamed("stripped", "text")

    def expand(spark, t, v):
        variants = patterns.expand(spark, seeds, ["temporal", "plural", "number", "case"]).select("variant").distinct()
        return variants.select(F.col("variant").alias("file_ord"), F.col("variant").alias("phrase"), F.lit("").alias("replace_with"), F.array().cast("array<string>").alias("ids"))

    def branch(spark, t, v):
        stages = {stage: lists[stage] for stage in ("inst_full", "inst_sub", "phrase")} | {"temporal": t["expand_temporal"]}
        return stripping.strip_lists(t["substitute"], stages, stripping.STAGES)

    def cleaned(spark, t, v):
        # long form: one clean-up expression for all variants, small enough for generated code; variants that agree are cleaned up once
        all_ = F.array(*[F.struct(F.lit(c).alias("variant"), F.col(c).alias("text")) for c in stripping.STAGES])
        rows = t["branch"].select("tinyId", "field_path", all_.alias("x")).select("tinyId", "field_path", "x", F.explode(F.array_distinct("x.text")).alias("text"))
        agree = F.transform(F.filter("x", lambda y: y["text"].eqNullSafe(F.col("text"))), lambda y: y["variant"])
        each = stripping.clean(rows.select("tinyId", "field_path", agree.alias("variants"), "text"), "text")
        return each.select("tinyId", "field_path", F.explode("variants").alias("variant"), "text")

    def report(spark, t, v):
        """(variant, n_texts, n_temporal, n_boilerplate, n_anchors): what is left of each kind of phrase."""
        hits = lambda p: F.sum(F.regexp_count(F.lower("text"), F.lit(p)))
        anchors = r"\b(?:" + "|".join(matching.ANCHORS) + r")\b"
        return t["clean"].groupBy("variant").agg(F.count(F.when(F.col("text") != "", 1)).alias("n_texts"), hits(matching.TEMPORAL).alias("n_temporal"), hits(matching.BOILERPLATE).alias("n_boilerplate"), hits(anchors).alias("n_anchors"))

    def embed(spark, t, v):
        """Names, then definitions of a record in the order of their places, joined; one row for each variant."""
        part = F.when(F.col("field_path").startswith("designations"), 0).when(F.col("field_path").startswith("definitions"), 1).otherwise(2)
        place = F.coalesce(F.regexp_extract("field_path", r"\[(\d+)\]", 1).try_cast("int"), F.lit(0))
        rows = t["clean"].where("text <> ''").select("tinyId", "variant", F.struct(part.alias("part"), place.alias("place"), "field_path", "text").alias("x")).where("x.part < 2")
        names = F.array_join(F.transform(F.filter("xs", lambda x: x["part"] == 0), lambda x: x["text"]), ";; ")
        definition = F.array_join(F.transform(F.filter("xs", lambda x: x["part"] == 1), lambda x: x["text"]), ";; ")
        return rows.groupBy("tinyId", "variant").agg(F.array_sort(F.collect_list("x")).alias("xs")).select("tinyId", "variant", F.concat_ws(" :--: ", F.nullif(names, F.lit("")), F.nullif(definition, F.lit(""))).alias("embed_text"))

    steps = [Step("substitute", substitute), Step("expand_temporal", expand), Step("branch", branch, materialise=True), Step("clean", cleaned, materialise=True), Step("report", report), Step("embed", embed)]
    return Workflow("production_strip", steps)
