"""Queries: projections, filters and counts on records."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.functions import paths, text as tx
from textlens.operators import aggregates as ag, fields, filters
from textlens.plans.corpus import items, texts, with_items, with_texts
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


@query("field_texts", with_texts("SELECT tinyId, field_path, text FROM texts"))
def _(spark, d):
    return texts(spark, d).select("tinyId", "field_path", "text")


@query("path_get_star", with_items("SELECT tinyId, array_to_string([x.designation FOR x IN designations IF x.designation IS NOT NULL], '|') AS names, definitions[1].definition AS first_definition FROM items WHERE designations IS NOT NULL"))
def _(spark, d):
    df = items(spark, d, "designations", "definitions").where("designations is not null")
    return df.select("tinyId", F.array_join(paths.get(df, "designations.*.designation"), "|").alias("names"), paths.get(df, "definitions.0.definition").alias("first_definition"))


@query("path_put", with_items("SELECT tinyId, array_to_string([upper(x.definition) FOR x IN definitions IF x.definition IS NOT NULL], '|') AS t FROM items WHERE definitions IS NOT NULL"))
def _(spark, d):
    df = items(spark, d, "definitions").where("definitions is not null")
    up = df.select("tinyId", paths.put(df, "definitions.*.definition", F.upper).alias("definitions"))
    return up.select("tinyId", F.array_join(paths.get(up, "definitions.*.definition"), "|").alias("t"))


_DOMAIN, _VALUE = ("datatype", "name", "definition", "uom", "vsacOid"), ("permissibleValue", "valueMeaningName", "valueMeaningDefinition", "valueMeaningCode", "codeSystemName", "codeSystemVersion", "conceptId", "conceptSource")
_LEAVES = " UNION ALL ".join(
    [f"SELECT 'valueDomain.{f}' AS path, valueDomain.{f} AS v FROM items WHERE valueDomain IS NOT NULL" for f in _DOMAIN]
    + [f"SELECT 'valueDomain.permissibleValues.*.{f}', e.{f} FROM items, unnest(valueDomain.permissibleValues) t(e) WHERE e IS NOT NULL" for f in _VALUE]
    + ["SELECT 'valueDomain.permissibleValues.*', NULL FROM items, unnest(valueDomain.permissibleValues) t(e) WHERE e IS NULL", "SELECT 'valueDomain.permissibleValues', NULL FROM items WHERE valueDomain IS NOT NULL AND valueDomain.permissibleValues IS NULL", "SELECT 'valueDomain', NULL FROM items WHERE valueDomain IS NULL"]
)


@query("leaf_walk", with_items(f", l AS ({_LEAVES}) SELECT path, count(*) AS n, count(v) AS n_set FROM l GROUP BY path"))
def _(spark, d):
    leaf = ag.leaf_rows(items(spark, d, "valueDomain"), [], ["valueDomain"])
    return leaf.groupBy("path").agg(F.count("*").alias("n"), F.count("value").alias("n_set"))


@query("name_question", with_items(r"""SELECT tinyId,
  coalesce(list_filter(designations, lambda e: e.designation IS NOT NULL AND len(list_filter(e.tags, lambda t: regexp_matches(t, 'Primary Name|Long Common Name|Short Name|Shortname'))) > 0)[1].designation, designations[1].designation) AS name,
  coalesce(list_filter(designations, lambda e: e.designation IS NOT NULL AND len(list_filter(e.tags, lambda t: regexp_matches(t, 'Question'))) > 0)[1].designation, designations[2].designation) AS question FROM items"""))
def _(spark, d):
    return items(spark, d, "designations").select("tinyId", fields.name_and_question(F.col("designations")).alias("x")).select("tinyId", "x.name", "x.question")


@query("pv_simplify", with_items(r""", v AS (SELECT tinyId, list_transform(list_filter(valueDomain.permissibleValues, lambda e: e IS NOT NULL), lambda e: {'v': coalesce(trim(e.permissibleValue), ''), 'm': coalesce(trim(coalesce(nullif(e.valueMeaningDefinition, ''), e.valueMeaningName)), '')}) AS p FROM items),
  w AS (SELECT tinyId, coalesce(array_to_string(list_filter(list_transform(p, lambda e: e.v), lambda s: s <> ''), ';; '), '') AS a, coalesce(array_to_string(list_filter(list_transform(p, lambda e: CASE WHEN e.m = e.v THEN '' ELSE e.m END), lambda s: s <> ''), ';; '), '') AS b FROM v)
  SELECT tinyId, CASE WHEN regexp_matches(a, '(?:\d+;;\s*)+\d+') THEN '' ELSE a END AS "values", CASE WHEN regexp_matches(b, '(?:\d+;;\s*)+\d+') THEN '' ELSE b END AS meanings FROM w"""))
def _(spark, d):
    return items(spark, d, "valueDomain").select("tinyId", fields.simplified_values(F.col("valueDomain.permissibleValues")).alias("x")).select("tinyId", "x.values", "x.meanings")


@query("embed_concat", with_items(r""", e AS (SELECT tinyId, coalesce(array_to_string([trim(x.designation) FOR x IN designations IF x.designation IS NOT NULL], ';; '), '') AS "Name", coalesce(trim(regexp_replace(definitions[1].definition, '\n+', ' ', 'g')), '') AS "Definition", coalesce(trim(stewardOrg.name), '') AS "Org" FROM items)
  SELECT tinyId, trim(regexp_replace(regexp_replace("Name", '\n+', ' ', 'g'), ' {2,}', ' ', 'g')) AS "Name", regexp_replace("Definition", ' {2,}', ' ', 'g') AS "Definition", "Org", concat_ws(' :--: ', nullif(trim(regexp_replace(regexp_replace("Name", '\n+', ' ', 'g'), ' {2,}', ' ', 'g')), ''), nullif(regexp_replace("Definition", ' {2,}', ' ', 'g'), ''), nullif("Org", '')) AS embed_text FROM e"""))
def _(spark, d):
    df = items(spark, d, "designations", "definitions", "stewardOrg")
    return df.select("tinyId", *fields.embed_text(df, {"Name": "designations.*.designation", "Definition": "definitions.0.definition", "Org": "stewardOrg.name"}))


@query("embed_schemaless", with_items("SELECT tinyId, designations[1].designation AS \"Name\", designations[2].designation AS \"Question\", definitions[1].definition AS \"Definition\", coalesce(array_to_string([x.permissibleValue FOR x IN valueDomain.permissibleValues IF x.permissibleValue IS NOT NULL], ';'), '') AS \"Pv1\" FROM items"))
def _(spark, d):
    df = items(spark, d, "designations", "definitions", "valueDomain")
    values = F.array_join(F.coalesce(paths.get(df, "valueDomain.permissibleValues.*.permissibleValue"), F.array().cast("array<string>")), ";")
    return df.select("tinyId", paths.get(df, "designations.0.designation").alias("Name"), paths.get(df, "designations.1.designation").alias("Question"), paths.get(df, "definitions.0.definition").alias("Definition"), values.alias("Pv1"))


@query("fix_underscores", "SELECT tinyId, x__v AS v FROM cde_item")
def _(spark, d):
    raw = table(spark, d, "cde_item").select("tinyId", F.col("x__v").alias("__v"))
    return fields.without_leading_underscore(raw).withColumnsRenamed({"x__v": "v"})


@query("subset_by_ids", with_items("SELECT tinyId FROM items WHERE tinyId IN (SELECT tinyId FROM occurrences WHERE phrase_id = 'phrase_00000')"))
def _(spark, d):
    ids = table(spark, d, "occurrences").where("phrase_id = 'phrase_00000'").select(F.col("tinyId").alias("id"))
    return filters.subset_by_ids(items(spark, d, "views"), ids, "tinyId").select("tinyId")


@query("subset_exclude_ids", with_items("SELECT tinyId FROM items WHERE tinyId NOT IN (SELECT tinyId FROM occurrences WHERE phrase_id = 'phrase_00000' AND tinyId IS NOT NULL)"))
def _(spark, d):
    ids = table(spark, d, "occurrences").where("phrase_id = 'phrase_00000'").select(F.col("tinyId").alias("id"))
    return filters.subset_by_ids(items(spark, d, "views"), ids, "tinyId", exclude=True).select("tinyId")


@query("subset_text", with_texts("SELECT DISTINCT tinyId FROM texts WHERE contains(lower(text), 'blood pressure')"))
def _(spark, d):
    return filters.subset_by_text(texts(spark, d), "tinyId", "Blood Pressure")


@query("subset_regex_exclude", with_texts(r"SELECT tinyId FROM texts GROUP BY tinyId HAVING NOT bool_or(regexp_matches(text, 'in the (past|previous) \d+ (days|hours)', 'i'))"))
def _(spark, d):
    return filters.subset_by_text(texts(spark, d), "tinyId", r"in the (past|previous) \d+ (days|hours)", regex=True, exclude=True)


_PATTERNS = [("(broken", "bad"), ("as part of the \\w+ battery", "battery"), ("since the last visit", "visit"), ("blood|heart", "heart")]


@query("pattern_file_match", with_texts(r""", m AS (SELECT tinyId, field_path, text, CASE WHEN regexp_matches(text, 'as part of the \w+ battery', 'i') THEN 0 WHEN regexp_matches(text, 'since the last visit', 'i') THEN 1 WHEN regexp_matches(text, 'blood|heart', 'i') THEN 2 END AS ord FROM texts),
  b AS (SELECT * FROM m WHERE ord IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tinyId ORDER BY ord, field_path, text) = 1)
  SELECT tinyId, ['as part of the \w+ battery', 'since the last visit', 'blood|heart'][ord + 1] AS pattern, ['battery', 'visit', 'heart'][ord + 1] AS label, text FROM b"""))
def _(spark, d):
    return filters.first_pattern(texts(spark, d), "tinyId", _PATTERNS)


@query("field_count_by_org", with_items("""SELECT coalesce(stewardOrg.name, '<unknown>') AS "group", 'designation' AS field, count(*) AS n FROM items, unnest(designations) t(e) WHERE e.designation IS NOT NULL AND e.designation NOT IN ('', 'null', '[]') GROUP BY 1"""))
def _(spark, d):
    df = items(spark, d, "designations", "stewardOrg").withColumn("org", F.col("stewardOrg.name"))
    return ag.count_fields(ag.leaf_rows(df, ["org"], ["designations"]), ["designation"], group="org")


@query("null_field_count", with_items("""SELECT '<global>' AS "group", f AS field, count(*) AS n FROM (SELECT unnest(['valueDomain.uom', 'valueDomain.datatype']) AS f, unnest([valueDomain.uom, valueDomain.datatype]) AS v FROM items WHERE valueDomain IS NOT NULL) WHERE v IS NULL OR v IN ('', 'null', '[]') GROUP BY 2"""))
def _(spark, d):
    return ag.count_fields(ag.leaf_rows(items(spark, d, "valueDomain"), [], ["valueDomain"]), ["valueDomain.uom", "valueDomain.datatype"], how="null")


@query("value_types", with_items(r"""SELECT '<global>' AS "group", 'permissibleValue' AS field, CASE WHEN regexp_matches(trim(v), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') THEN CASE WHEN regexp_matches(trim(v), '^[+-]?\d+(\.0+)?$') THEN 'int' ELSE 'float' END WHEN length(v) < 10 THEN 'str10' ELSE 'str' END AS type, count(*) AS n
  FROM (SELECT e.permissibleValue AS v FROM items, unnest(valueDomain.permissibleValues) t(e)) WHERE v IS NOT NULL AND v NOT IN ('', 'null', '[]') GROUP BY 3"""))
def _(spark, d):
    return ag.count_fields(ag.leaf_rows(items(spark, d, "valueDomain"), [], ["valueDomain"]), ["permissibleValue"], with_type=True)


@query("field_glob_regex", with_items(r"""SELECT '<global>' AS "group", 'definition' AS field, count(*) AS n FROM items, unnest(definitions) t(e) WHERE e.definition IS NOT NULL AND e.definition NOT IN ('', '[]') AND regexp_matches(e.definition, '\d') HAVING count(*) > 0"""))
def _(spark, d):
    return ag.count_fields(ag.leaf_rows(items(spark, d, "definitions"), [], ["definitions"]), ["definitions.*.def*n"], how="regex", pattern=r"\d")


@query("logic_expr_count", with_items("""SELECT count(*) AS n FROM items WHERE (stewardOrg.name IS NOT NULL AND NOT views IS NOT NULL) OR registrationState.registrationStatus IS NULL"""))
def _(spark, d):
    flags = {"org": F.col("stewardOrg.name").isNotNull(), "views": F.col("views").isNotNull(), "status": F.col("registrationState.registrationStatus").isNotNull()}
    keep = filters.Logic("(org and not views) or not status").column(flags)
    return items(spark, d, "stewardOrg", "registrationState", "views").where(keep).agg(F.count("*").alias("n"))


@query("dedup_texts", with_texts(r", t AS (SELECT tinyId, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM texts) SELECT sha256(t) AS text_hash, count(*) AS n_occurrences, count(DISTINCT tinyId) AS n_ids, min(t) AS sample_text FROM t GROUP BY 1 HAVING count(DISTINCT tinyId) >= 2"))
def _(spark, d):
    return ag.duplicate_texts(texts(spark, d))


@query("document_duplicates", r"SELECT sha256(t) AS text_hash, count(*) AS n_occurrences, count(DISTINCT doc_id) AS n_ids, min(t) AS sample_text FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2")
def _(spark, d):
    return ag.duplicate_texts(table(spark, d, "documents").where("text is not null"), "doc_id")


@query("corpus_fingerprint", with_items("SELECT count(*) AS n_ids, CAST(sum(CAST('0x' || substr(sha256(tinyId), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS sum_a, CAST(sum(CAST('0x' || substr(sha256(tinyId), 16, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS sum_b FROM items"))
def _(spark, d):
    return ag.fingerprint(table(spark, d, "cde_item"), "tinyId")


@query("vocab_rank", with_texts(", w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM texts), c AS (SELECT token, count(*) AS n FROM w GROUP BY 1) SELECT token, n, CASE WHEN n >= 2 AND row_number() OVER (ORDER BY n DESC, token) <= 10500 THEN row_number() OVER (ORDER BY n DESC, token) ELSE 0 END AS rank FROM c"))
def _(spark, d):
    return ag.vocabulary(texts(spark, d))


@query("group_value_last", with_items("SELECT coalesce(stewardOrg.name, '<unknown>') AS value, count(*) AS n FROM items GROUP BY 1"))
def _(spark, d):
    return items(spark, d, "stewardOrg").groupBy(F.coalesce("stewardOrg.name", F.lit("<unknown>")).alias("value")).agg(F.count("*").alias("n"))


@query("group_value_terminal", with_items("SELECT tinyId, coalesce(valueDomain.uom, '<unknown>') AS \"group\" FROM items"))
def _(spark, d):
    return ag.group_values(items(spark, d, "valueDomain", "stewardOrg"), "tinyId", "uom", "terminal", ["valueDomain", "stewardOrg"])


@query("slug_names", "SELECT DISTINCT instrument_name AS name, regexp_replace(regexp_replace(lower(trim(instrument_name)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM instrument_match WHERE instrument_name IS NOT NULL")
def _(spark, d):
    return table(spark, d, "instrument_match").where("instrument_name is not null").select(F.col("instrument_name").alias("name"), tx.slug(F.col("instrument_name")).alias("slug")).distinct()


@query("concat_columns", "SELECT row_id, concat_ws(' ', nullif(trim(pattern), ''), nullif(trim(type), ''), nullif(trim(source), '')) AS text FROM inst_full_patterns")
def _(spark, d):
    return table(spark, d, "inst_full_patterns").select("row_id", F.concat_ws(" ", *[F.nullif(F.trim(c), F.lit("")) for c in ("pattern", "type", "source")]).alias("text"))
