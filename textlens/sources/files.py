"""Readers and writers of corpora, pattern lists, id lists, path schemas, configurations and reports.

Readers return DataFrames and let Spark do the parsing. Small driver-side files (schemas, YAML) become
Python values or small DataFrames.
"""

from __future__ import annotations

import csv
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textlens.operators.nested import RECORD

ID_SEPARATORS = r"[\s|,;]+"


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, broken): JSON records by schema, one a line, or one object or list a file; texts that do not parse go to broken (column text)."""
    kind = T.ArrayType(schema)
    rows = spark.read.text(path, wholetext=not lines).where("trim(value) <> ''").select(F.col("value").alias("text"), F.from_json("value", kind, {"mode": "PERMISSIVE"}).alias("r"))
    rows = rows.withColumn("ok", F.try_parse_json("text").isNotNull() & F.col("r").isNotNull())
    return rows.where("ok").select(F.explode("r").alias("r")).select("r.*"), rows.where("not ok").select("text")


def _column(df: DataFrame, wanted: str) -> str:
    by_lower = {c.lower(): c for c in df.columns}
    if wanted.lower() not in by_lower:
        raise ValueError(f"no column {wanted}; there are {df.columns}")
    return by_lower[wanted.lower()]


def read_tsv(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited file with a header; quotes stay as they are except that spreadsheet quoting of whole cells is undone."""
    df = spark.read.csv(path, sep=sep, header=True, quote="" if sep == "\t" else '"', escape='"')
    if sep != "\t":
        return df
    repaired = [F.regexp_replace(F.regexp_replace(F.col(f"`{c}`"), r'^"(.*)"$', "$1"), '""', '"').alias(c) for c in df.columns]
    return df.select(*repaired)


def ids(cell: Column) -> Column:
    """Array of ids packed in a cell, whatever separates them; empty for null."""
    return F.filter(F.split(F.coalesce(F.regexp_replace(cell, r"[\[\]\"']", ""), F.lit("")), ID_SEPARATORS), lambda x: x != "")


def read_patterns(spark: SparkSession, spec: str) -> DataFrame:
    """(file_ord, pattern, ids, replace_with) from ``file[,pattern column[,ids column]]``; the first row of a pattern wins.

    The pattern column defaults to full_match, else pattern; an empty id list means every record.
    """
    path, *names = spec.split(",")
    df = read_tsv(spark, path)
    low = [c.lower() for c in df.columns]
    pattern = _column(df, names[0]) if names else _column(df, "full_match" if "full_match" in low else "pattern")
    id_col = _column(df, names[1]) if len(names) > 1 else next((c for c in df.columns if c.lower() == "tinyids"), None)
    replacement = next((c for c in df.columns if c.lower() == "replace_with"), None)
    rows = df.select(
        F.monotonically_increasing_id().alias("file_ord"), F.col(f"`{pattern}`").alias("pattern"),
        (ids(F.col(f"`{id_col}`")) if id_col else F.array().cast("array<string>")).alias("ids"),
        (F.coalesce(F.col(f"`{replacement}`"), F.lit("")) if replacement else F.lit("")).alias("replace_with"),
    ).where("pattern is not null and trim(pattern) <> ''")
    return rows.groupBy("pattern").agg(F.min(F.struct("file_ord", "ids", "replace_with")).alias("m")).select("m.file_ord", "pattern", "m.ids", "m.replace_with")


def pattern_ids(patterns: DataFrame) -> DataFrame:
    """(pattern, tinyId) long form; universal patterns have one row with a null id."""
    return patterns.select("pattern", F.explode_outer("ids").alias("tinyId"))


def read_parents(spark: SparkSession, path: str) -> DataFrame:
    """(pattern, parent_phrase, parent_tinyid_count): the parent of each pattern and its distinct records."""
    df = read_tsv(spark, path)
    rows = df.select(F.col(_column(df, "pattern")).alias("pattern"), F.col(_column(df, "parent_phrase")).alias("parent_phrase"), ids(F.col(_column(df, "tinyIds"))).alias("ids"))
    n = rows.select("parent_phrase", F.explode("ids").alias("i")).groupBy("parent_phrase").agg(F.countDistinct("i").alias("parent_tinyid_count"))
    return rows.select("pattern", "parent_phrase").distinct().join(n, "parent_phrase", "left").select("pattern", "parent_phrase", F.coalesce("parent_tinyid_count", F.lit(0)).alias("parent_tinyid_count"))


def read_ids(spark: SparkSession, spec: str) -> DataFrame:
    """(ord, id): distinct ids of a JSON list or object (the list under tinyIds or tinyId, else its keys), a CSV/TSV column (``file:column``) or a plain list, first place kept."""
    path, _, column = spec.partition(":") if not re.match(r"^\w+://", spec) else (*spec.rsplit(":", 1)[:1], "", "")
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True)
        listed = F.coalesce(F.from_json("value", "array<string>"), F.from_json("value", "struct<tinyIds:array<string>>")["tinyIds"], F.from_json("value", "struct<tinyId:array<string>>")["tinyId"], F.map_keys(F.from_json("value", "map<string,string>")))
        cells = whole.select(F.explode(listed).alias("cell"))
    elif path.endswith((".csv", ".tsv")):
        df = read_tsv(spark, path, "," if path.endswith(".csv") else "\t")
        cells = df.select(F.col(f"`{_column(df, column or df.columns[0])}`").alias("cell"))
    else:
        cells = spark.read.text(path).select(F.col("value").alias("cell"))
    rows = cells.withColumn("row", F.monotonically_increasing_id()).select("row", F.posexplode(ids(F.col("cell"))).alias("pos", "id"))
    return rows.groupBy("id").agg(F.min(F.struct("row", "pos")).alias("ord")).select("ord", "id")


def read_phrase_map(spark: SparkSession, path: str) -> DataFrame:
    """(ord, path, phrase, replace, ids) of a JSON or TSV replacement list."""
    if path.endswith(".json"):
        df = spark.read.schema("path string, phrase string, replace string, tinyIds array<string>").json(path, multiLine=True)
        return df.select(F.monotonically_increasing_id().alias("ord"), "path", "phrase", F.coalesce("replace", F.lit("")).alias("replace"), F.coalesce("tinyIds", F.array().cast("array<string>")).alias("ids"))
    df = read_tsv(spark, path)
    pick = lambda c: F.col(f"`{_column(df, c)}`")
    return df.select(F.monotonically_increasing_id().alias("ord"), pick("path").alias("path"), pick("phrase").alias("phrase"), F.coalesce(pick("replace"), F.lit("")).alias("replace"), ids(pick("tinyIds")).alias("ids"))


def read_regexes(spark: SparkSession, path: str) -> DataFrame:
    """(ord, pattern, label) of ``pattern<TAB>label`` lines; # starts a comment line."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), "value").where("trim(value) <> '' and not value like '#%'")
    parts = F.split("value", "\t")
    return rows.select("ord", F.trim(F.get(parts, F.lit(0))).alias("pattern"), F.coalesce(F.trim(F.get(parts, F.lit(1))), F.lit("")).alias("label"))


def read_path_schema(path: str) -> dict[str, str]:
    """tag -> path of a JSON object or a two-column CSV/TSV."""
    with open(path, encoding="utf-8", newline="") as f:
        if path.endswith(".json"):
            return dict(json.load(f))
        rows = list(csv.reader(f, delimiter="\t" if path.endswith(".tsv") else ","))
    return {r[0].strip(): r[1].strip() for r in rows[1 if rows and rows[0][:1] in (["tag"], ["Tag"]) else 0 :] if len(r) > 1}


def read_config(*paths: str) -> dict:
    """YAML files in order; lists of a later file extend those of an earlier one (new entries only), mappings merge at every depth, other values replace. Missing files are skipped."""
    import yaml

    out: dict = {}
    for p in paths:
        try:
            with open(p, encoding="utf-8") as f:
                new = yaml.safe_load(f) or {}
        except FileNotFoundError:
            continue
        out = _extended(out, new)
    return out


def _extended(old: dict, new: dict) -> dict:
    out = dict(old)
    for k, v in new.items():
        have = out.get(k)
        if isinstance(v, list) and isinstance(have, list):
            out[k] = have + [x for x in v if x not in have]
        else:
            out[k] = _extended(have, v) if isinstance(v, dict) and isinstance(have, dict) else v
    return out


def write_yaml(value, path: str) -> None:
    """A Python value (a configuration, not data) as YAML, keys in order of their names."""
    import yaml

    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(value, f, sort_keys=True, allow_unicode=True)


def bracket_scopes(patterns: dict[str, list[str] | None]) -> dict[str, list[str] | None]:
    """``[TAG]`` patterns also give bare ``TAG`` with the same scope; scopes of one pattern unite; None (universal) stays universal."""
    out: dict[str, list[str] | None] = dict(patterns)
    for p, scope in patterns.items():
        if re.fullmatch(r"\[.+\]", p):
            bare = p[1:-1]
            if bare not in out:
                out[bare] = scope
            elif out[bare] is not None:
                out[bare] = None if scope is None else sorted({*out[bare], *scope})
    return out


DICTIONARY = "abbreviation string, expansion string, category string, confidence double, source string, n_tinyIds int, decision string, notes string"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """An abbreviation dictionary (TSV with the columns of DICTIONARY, in any order, missing ones null)."""
    df = read_tsv(spark, path)
    have = {c.lower(): c for c in df.columns}
    kinds = [f.split(" ") for f in DICTIONARY.split(", ")]
    return df.select(*[(F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in kinds])


def write_dictionary(df: DataFrame, path: str) -> None:
    """The dictionary as TSV; blank decisions become tentative ones by category and confidence."""
    sure = F.col("confidence") >= 0.8
    guess = F.when(F.col("category").isin("instrument", "study") & sure, "tentative_strip").otherwise("tentative_skip")
    write_flat(df.withColumn("decision", F.coalesce(F.nullif(F.trim("decision"), F.lit("")), guess)), path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(phase, pattern, decision, modification, decided_at, notes): a decision ledger in TSV, old words mapped, the last row of a key wins."""
    from textlens.operators.curation import decision

    df = read_tsv(spark, path)
    have = {c.lower(): c for c in df.columns}
    pick = lambda c: F.col(f"`{have[c]}`") if c in have else F.lit(None).cast("string")
    rows = df.select(F.coalesce(pick("phase"), F.lit("")).alias("phase"), pick("pattern").alias("pattern"), decision(pick("decision")).alias("decision"), pick("modification").alias("modification"), pick("decided_at").alias("decided_at"), pick("notes").alias("notes"), F.monotonically_increasing_id().alias("row")).where("pattern is not null and pattern <> ''")
    rest = ["decision", "modification", "decided_at", "notes"]
    return rows.groupBy("phase", "pattern").agg(F.max(F.struct(F.coalesce("decided_at", F.lit("")).alias("at"), "row", *rest)).alias("m")).select("phase", "pattern", *[F.col(f"m.{c}").alias(c) for c in rest])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_flat(df: DataFrame, path: str, sep: str = "\t") -> None:
    """CSV or TSV with columns in alphabetical order; nested columns as JSON."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    cols = [F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, nested) else F.col(f"`{c}`") for c in sorted(df.columns)]
    df.select(*cols).write.mode("overwrite").csv(path, sep=sep, header=True, escape='"')


def path_phrases(ids_long: DataFrame) -> DataFrame:
    """(path, phrase, ids): distinct ids joined by ``;`` in order, from (path, phrase, tinyId) metadata rows."""
    return ids_long.groupBy("path", "phrase").agg(F.array_join(F.array_sort(F.collect_set("tinyId")), ";").alias("ids"))


def id_histogram(counts: DataFrame) -> DataFrame:
    """(k, n_ids, n): how many phrases of each length have each number of records."""
    return counts.groupBy("k", "n_ids").agg(F.count("*").alias("n"))


def markdown(df: DataFrame, title: str, most: int = 50) -> str:
    """A report table of at most ``most`` rows (a view, not a result)."""
    rows = df.limit(most).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]) + "\n"


def read_phrases(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """(phrase_id, text, tokens, ids) of a phrase table in TSV, as grouping and family analysis take it."""
    df = read_tsv(spark, path)
    have = {c.lower(): c for c in df.columns}
    text = F.col(f"`{have.get('text') or have.get('phrase_text') or _column(df, 'phrase')}`")
    text = F.lower(text) if lower else text
    own = ids(F.col(f"`{have['tinyids']}`")) if "tinyids" in have else F.array().cast("array<string>")
    return df.select(F.col(f"`{_column(df, 'phrase_id')}`").alias("phrase_id"), text.alias("text"), F.filter(F.split(text, " "), lambda w: w != "").alias("tokens"), own.alias("ids")).where("text is not null and text <> ''")


def write_ledger(df: DataFrame, path: str, meta: dict | None = None) -> None:
    """A decision ledger as TSV (phase, pattern, decision, modification, decided_at, notes) and, in ``meta.json`` beside it, what is known of the run."""
    cols = ["phase", "pattern", "decision", "modification", "decided_at", "notes"]
    write_flat(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols]), path)
    if meta is not None:
        spark = df.sparkSession
        spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".meta.json")


def expected_ids(patterns: DataFrame) -> DataFrame:
    """(pattern, tinyId) of patterns with their own records; a pattern without ids is for every record and has no row."""
    return patterns.where(F.size("ids") > 0).select("pattern", F.explode("ids").alias("tinyId")).distinct()
