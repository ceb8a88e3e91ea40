"""Queries: every reader on a file that was written from a table, so that SQL on the table tells what must come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import nested
from textlens.plans.corpus import items, with_items
from textlens.session import scratch, table
from textlens.sources import files

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _saved(df, ending: str = "tsv") -> str:
    """df in a file of the shared folder."""
    path = scratch(df.sparkSession, "source") + f"/file.{ending}"
    if ending == "tsv":
        files.write_flat(df, path)
    elif ending == "json":
        files.write_json(df, path)
    else:
        df.write.text(path)
    return path


_IDS = r"list_filter(string_split_regex(regexp_replace(coalesce(tinyIds, ''), '[\[\]\"'']', '', 'g'), '[\s|,;]+'), lambda x: x <> '')"


@query("read_json_records", with_items("SELECT tinyId, coalesce(len(designations), 0) AS n_designations, definitions[1].definition AS first_definition, coalesce(len(valueDomain.permissibleValues), 0) AS n_values FROM items"))
def _(spark, d):
    rows = items(spark, d, "designations", "definitions", "valueDomain").select("tinyId", "designations", "definitions", "valueDomain")
    good, _ = files.read_records(spark, _saved(rows, "json"), lines=True)
    n = lambda c: F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0)).cast("bigint")
    return good.select("tinyId", n(F.col("designations")).alias("n_designations"), F.get("definitions", F.lit(0))["definition"].alias("first_definition"), n(F.col("valueDomain.permissibleValues")).alias("n_values"))


@query("read_broken_records", "SELECT count(*) FILTER (NOT ok) AS n_broken FROM (SELECT payload, json_valid(payload) AS ok FROM cde_raw WHERE trim(payload) <> '' AND NOT contains(payload, chr(10)) AND NOT contains(payload, 'NaN') AND NOT contains(payload, 'Infinity'))")
def _(spark, d):
    raw = table(spark, d, "cde_raw").where("trim(payload) <> '' and not contains(payload, '\n') and not contains(payload, 'NaN') and not contains(payload, 'Infinity')")
    _, bad = files.read_records(spark, _saved(raw.select(F.col("payload").alias("value")), "txt"), lines=True)
    return bad.where("try_parse_json(text) is null").agg(F.count("*").alias("n_broken"))


def _pattern_file(spark, d):
    rows = table(spark, d, "inst_full_patterns").where("pattern is not null and trim(pattern) <> '' and row_id is not null")
    one = rows.groupBy("pattern").agg(F.min(F.struct("row_id", F.coalesce(F.translate("tinyIds", "\n\t\r", "   "), F.lit("")).alias("tinyIds"))).alias("m"))
    return _saved(one.select(F.col("pattern").alias("full_match"), F.col("m.tinyIds").alias("tinyIds")))


_ONE = "p AS (SELECT pattern, arg_min(coalesce(tinyIds, ''), row_id) AS tinyIds FROM inst_full_patterns WHERE pattern IS NOT NULL AND trim(pattern) <> '' GROUP BY 1)"


@query("read_patterns", f"WITH {_ONE} SELECT pattern, array_to_string({_IDS}, ' ') AS ids FROM p")
def _(spark, d):
    return files.read_patterns(spark, _pattern_file(spark, d)).select("pattern", F.array_join("ids", " ").alias("ids"))


@query("read_expected_ids", f"WITH {_ONE} SELECT DISTINCT pattern, unnest({_IDS}) AS tinyId FROM p")
def _(spark, d):
    return files.expected_ids(files.read_patterns(spark, f"{_pattern_file(spark, d)},FULL_MATCH,tinyids"))


@query("read_minimal_patterns", f"WITH {_ONE} SELECT pattern, CAST(len({_IDS}) AS BIGINT) AS n_ids FROM p")
def _(spark, d):
    return files.pattern_ids(files.read_patterns(spark, _pattern_file(spark, d))).groupBy("pattern").agg(F.count("tinyId").alias("n_ids"))


@query("read_parents", rf"WITH s AS (SELECT pattern, parent_phrase, {_IDS} AS ids FROM substitute_patterns WHERE pattern IS NOT NULL AND parent_phrase IS NOT NULL AND trim(parent_phrase) <> ''), n AS (SELECT parent_phrase, count(DISTINCT i) AS n FROM (SELECT parent_phrase, unnest(ids) AS i FROM s) GROUP BY 1) SELECT DISTINCT pattern, parent_phrase, coalesce(n, 0) AS parent_tinyid_count FROM s LEFT JOIN n USING (parent_phrase)")
def _(spark, d):
    s = table(spark, d, "substitute_patterns").where("pattern is not null and parent_phrase is not null and trim(parent_phrase) <> ''")
    return files.read_parents(spark, _saved(s.select("pattern", "parent_phrase", F.translate("tinyIds", "\n\t\r", "   ").alias("tinyIds"))))


@query("read_id_list", f"SELECT DISTINCT unnest({_IDS}) AS id FROM inst_full_patterns")
def _(spark, d):
    rows = table(spark, d, "inst_full_patterns").select("row_id", F.translate("tinyIds", "\n\t\r", "   ").alias("tinyIds"))
    return files.read_ids(spark, f"{_saved(rows)}:tinyIds".replace("file:", "", 1)).select("id")


@query("read_phrase_map", f"SELECT 'definitions.*.definition' AS path, pattern AS phrase, coalesce(replace_with, '') AS replace, CAST(len({_IDS}) AS BIGINT) AS n_ids FROM substitute_patterns WHERE pattern IS NOT NULL AND trim(pattern) <> ''")
def _(spark, d):
    s = table(spark, d, "substitute_patterns").where("pattern is not null and trim(pattern) <> ''")
    path = _saved(s.select(F.lit("definitions.*.definition").alias("path"), F.col("pattern").alias("phrase"), F.col("replace_with").alias("replace"), F.translate("tinyIds", "\n\t\r", "   ").alias("tinyIds")))
    return files.read_phrase_map(spark, path).select("path", "phrase", "replace", F.size("ids").cast("bigint").alias("n_ids"))


@query("read_regex_file", "SELECT DISTINCT trim(text) AS pattern, phrase_id AS label FROM phrases WHERE text IS NOT NULL AND trim(text) <> '' AND phrase_id IS NOT NULL AND NOT starts_with(text, '#')")
def _(spark, d):
    lines = table(spark, d, "phrases").where("text is not null and trim(text) <> '' and phrase_id is not null and not startswith(text, '#')").select(F.concat_ws("\t", "text", "phrase_id").alias("value"))
    more = spark.createDataFrame([("# a comment",), ("  ",)], "value string")
    return files.read_regexes(spark, _saved(lines.unionByName(more), "txt")).select("pattern", "label").distinct()


@query("read_dictionary", "SELECT acronym AS abbreviation, count(*) AS n_tinyIds, CASE WHEN count(*) >= 3 THEN 'tentative_strip' ELSE 'tentative_skip' END AS decision FROM instrument_match WHERE acronym IS NOT NULL AND trim(acronym) <> '' AND NOT contains(acronym, '\"') AND acronym = trim(acronym) GROUP BY 1")
def _(spark, d):
    m = table(spark, d, "instrument_match").where("acronym is not null and trim(acronym) <> '' and not contains(acronym, '\"') and acronym = trim(acronym)")
    n = m.groupBy(F.col("acronym").alias("abbreviation")).agg(F.count("*").alias("n_tinyIds"))
    full = n.select("abbreviation", F.lit("x").alias("expansion"), F.lit("instrument").alias("category"), F.when(F.col("n_tinyIds") >= 3, 0.9).otherwise(0.5).alias("confidence"), F.lit("test").alias("source"), "n_tinyIds", F.lit("").alias("decision"), F.lit("").alias("notes"))
    path = scratch(spark, "source") + "/file.tsv"
    files.write_dictionary(full, path)
    return files.read_dictionary(spark, path).select("abbreviation", F.col("n_tinyIds").cast("bigint").alias("n_tinyIds"), "decision")


@query("read_ledger", "SELECT pattern_id, CASE d WHEN 'keep' THEN 'strip' WHEN 'remove' THEN 'skip' ELSE d END AS decision FROM (SELECT pattern_id, lower(trim(decision)) AS d, decided_at FROM curation_decision WHERE pattern_id IS NOT NULL AND decided_at IS NOT NULL AND trim(decision) <> '') QUALIFY row_number() OVER (PARTITION BY pattern_id ORDER BY decided_at DESC, d DESC) = 1")
def _(spark, d):
    c = table(spark, d, "curation_decision").where("pattern_id is not null and decided_at is not null and trim(decision) <> ''")
    top = c.groupBy("pattern_id").agg(F.max(F.struct("decided_at", F.lower(F.trim("decision")).alias("decision"))).alias("m"))
    rows = top.select(F.lit("phase").alias("phase"), F.col("pattern_id").cast("string").alias("pattern"), F.col("m.decision").alias("decision"), F.col("m.decided_at").cast("string").alias("decided_at"))
    path = scratch(spark, "source") + "/file.tsv"
    files.write_ledger(rows, path, {"run": 1})
    return files.read_ledger(spark, path).select(F.col("pattern").cast("bigint").alias("pattern_id"), "decision")


@query("read_phrase_table", "SELECT DISTINCT phrase_id, text, CAST(len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS BIGINT) AS n_tokens FROM phrases WHERE phrase_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
def _(spark, d):
    p = table(spark, d, "phrases").where("phrase_id is not null").select("phrase_id", "text")
    return files.read_phrases(spark, _saved(p)).select("phrase_id", "text", F.size("tokens").cast("bigint").alias("n_tokens")).distinct()


@query("flat_sink", "SELECT match_id, acronym, char_start FROM instrument_match WHERE match_id IS NOT NULL AND (acronym IS NULL OR (acronym = trim(acronym) AND acronym <> ''))")
def _(spark, d):
    m = table(spark, d, "instrument_match").where("match_id is not null and (acronym is null or (acronym = trim(acronym) and acronym <> ''))")
    back = files.read_tsv(spark, _saved(m.select("match_id", "char_start", "acronym")))
    return back.select(F.col("match_id").cast("bigint").alias("match_id"), "acronym", F.col("char_start").cast("int").alias("char_start"))


@query("raw_record_versions", None)
def _(spark, d):
    return nested.parse_records(table(spark, d, "cde_raw").select("payload")).select("tinyId", "__v")
