"""Queries: instruments, abbreviations, patterns, verbatim forms, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import aggregates as ag, encoding as en, instruments as ins, patterns as pt, verbatim as vb
from textlens.operators import grouping as gr
from textlens.plans.corpus import SQL_EVERYTHING, everything, texts, with_everything, with_texts
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _found(spark, d):
    return table(spark, d, "instrument_match").where("instrument_name is not null").select("tinyId", "instrument_name", F.upper(F.regexp_replace("acronym", r"[()\[\] ]", "")).alias("acronym"))


_FOUND = "f AS (SELECT tinyId, instrument_name, upper(regexp_replace(acronym, '[()\\[\\] ]', '', 'g')) AS acronym FROM instrument_match WHERE instrument_name IS NOT NULL)"


_M, _A = ins.MENTION.replace("'", "''"), ins.ACRONYM_ONLY.replace("'", "''")
_WELL = "list_filter(string_split_regex(trim(instrument_name), '\\s+'), lambda w: regexp_full_match(w, '\\d+') OR lower(w) IN (" + ", ".join(f"'{w}'" for w in ins.MINOR) + ") OR regexp_matches(regexp_replace(w, '[^A-Za-z]', '', 'g'), '^[A-Z]'))"


@query("instrument_mentions", with_everything(f", m AS (SELECT tinyId, field_path, unnest(regexp_extract_all(text, '{_M}')) AS full_match FROM every), x AS (SELECT tinyId, field_path, full_match, trim(regexp_extract(full_match, '{_M}', 1)) AS instrument_name, nullif(regexp_extract(full_match, '{_M}', 2), '') AS acronym FROM m) SELECT * FROM x WHERE len(string_split_regex(trim(instrument_name), '\\s+')) >= 3 AND len({_WELL}) / len(string_split_regex(trim(instrument_name), '\\s+')) > 0.6"))
def _(spark, d):
    return ins.mentions(everything(spark, d))


@query("acronym_only_mentions", with_everything(f", {_FOUND}, n AS (SELECT acronym, instrument_name, count(*) AS n FROM f WHERE acronym IS NOT NULL GROUP BY 1, 2), b AS (SELECT acronym, instrument_name FROM n QUALIFY row_number() OVER (PARTITION BY acronym ORDER BY n DESC, instrument_name) = 1), a AS (SELECT tinyId, field_path, unnest(regexp_extract_all(text, '{_A}', 1)) AS acronym FROM every) SELECT tinyId, field_path, coalesce(b.instrument_name, '[' || a.acronym || ']') AS instrument_name, a.acronym FROM a LEFT JOIN b ON b.acronym = a.acronym"))
def _(spark, d):
    return ins.acronym_mentions(everything(spark, d), ins.acronym_names(_found(spark, d)))


@query("acronym_names", f"WITH {_FOUND}, n AS (SELECT acronym, instrument_name, count(*) AS n FROM f WHERE acronym IS NOT NULL GROUP BY 1, 2) SELECT acronym, instrument_name FROM n QUALIFY row_number() OVER (PARTITION BY acronym ORDER BY n DESC, instrument_name) = 1")
def _(spark, d):
    return ins.acronym_names(_found(spark, d))


@query("instrument_catalog", f"WITH {_FOUND}, k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(trim(instrument_name)), '\\s+', ' ', 'g'), '^(the|a|an) ', '')) AS name_key FROM f), s AS (SELECT name_key, instrument_name, count(*) AS c FROM k GROUP BY 1, 2), b AS (SELECT name_key, instrument_name FROM s QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY c DESC, instrument_name) = 1) SELECT k.name_key, b.instrument_name, count(*) AS n, count(DISTINCT k.tinyId) AS n_ids, coalesce(array_to_string(list_sort(list(DISTINCT k.acronym)), '|'), '') AS acronyms FROM k JOIN b USING (name_key) GROUP BY 1, 2 HAVING count(DISTINCT k.tinyId) >= 2")
def _(spark, d):
    return ins.catalog(_found(spark, d))


@query("instrument_surface_forms", f"WITH {_FOUND}, n AS (SELECT instrument_name, count(*) AS n, count(DISTINCT tinyId) AS n_ids FROM f GROUP BY 1), a AS (SELECT instrument_name, acronym, count(*) AS c FROM f WHERE acronym IS NOT NULL GROUP BY 1, 2), b AS (SELECT instrument_name, acronym FROM a QUALIFY row_number() OVER (PARTITION BY instrument_name ORDER BY c DESC, acronym) = 1) SELECT n.instrument_name, n, n_ids, b.acronym FROM n LEFT JOIN b ON b.instrument_name = n.instrument_name")
def _(spark, d):
    return ins.surface_forms(_found(spark, d))


@query("spelling_variants")
def _(spark, d):
    return ins.spelling_variants(_found(spark, d))


_RULES = [("rating", r"\brating form\b", 1.0), ("survey", r"\b(survey|srv|survy)\b", 0.9), ("index", r"\b(index|idx|indx)\b", 0.9), ("scale", r"\b(scale|sc\.|scl)", 0.8)]
_FAM = "CASE WHEN regexp_matches(instrument_name, '^the ', 'i') THEN 'unknown' " + " ".join(f"WHEN regexp_matches(instrument_name, '{p}', 'i') THEN '{f}'" for f, p, _ in _RULES) + " ELSE 'other' END"
_CONF = "CASE WHEN regexp_matches(instrument_name, '^the ', 'i') THEN 0.0 " + " ".join(f"WHEN regexp_matches(instrument_name, '{p}', 'i') THEN {c}" for _, p, c in _RULES) + " ELSE 0.5 END"


@query("family_detect", f"WITH {_FOUND} SELECT DISTINCT instrument_name, {_FAM} AS family_id, CAST({_CONF} AS DOUBLE) AS confidence FROM f")
def _(spark, d):
    return ins.families(_found(spark, d), _RULES, "^the ")


@query("family_summary", f"WITH {_FOUND} SELECT {_FAM} AS family_id, count(DISTINCT instrument_name) AS n_instruments, count(DISTINCT tinyId) AS n_ids, count(*) AS n FROM f GROUP BY 1")
def _(spark, d):
    f = _found(spark, d)
    return ins.family_summary(f, ins.families(f, _RULES, "^the "))


_FILL = "|".join(ins.FILLERS)
# the tail of t whose initials spell a: the greedy prefix of the regex makes the first letter's place the right-most one
_ALIGN = (
    r"w0 AS (SELECT *, list_filter(string_split_regex(trim(t), '\s+'), lambda w: regexp_matches(w, '[^\s,;:]')) AS ws, regexp_extract_all(upper(a), '[A-Z]') AS ls FROM x), "
    r"w1 AS (SELECT *, flatten(list_transform(range(1, len(ws) + 1), lambda i: list_transform(list_filter(string_split_regex(ws[i], '[-/]'), lambda p: regexp_matches(p, '^[\s,;:]*[A-Za-z]')), lambda p: {'i': i, 'l': upper(regexp_extract(p, '[A-Za-z]'))}))) AS ii FROM w0), "
    r"w2 AS (SELECT *, array_to_string(list_transform(ii, lambda y: y.l), '') AS s, '^(.*)' || array_to_string(ls, '.*') AS rx FROM w1), "
    r"w3 AS (SELECT *, CASE WHEN len(ls) > 0 AND regexp_matches(s, rx) THEN ii[length(regexp_extract(s, rx, 1)) + 1].i END AS b FROM w2), "
    rf"w4 AS (SELECT *, regexp_replace(regexp_replace(array_to_string(ws[b:], ' '), '(?i)^(?:(?:{_FILL})\s+)+(\S)', '\1'), '^[\s,;:]+|[\s,;:]+$', '', 'g') AS c FROM w3), "
    r"al AS (SELECT * EXCLUDE (ws, ls, ii, s, rx, b, c), regexp_replace(CASE WHEN b IS NOT NULL AND c <> '' THEN c ELSE trim(t) END, '(?i)^(?:the|a|an)\s+', '') AS expansion FROM w4)"
)
_PAREN = ins._PAREN.replace("'", "''")
_IN_PAREN = SQL_EVERYTHING + f", m AS (SELECT tinyId, unnest(regexp_extract_all(text, '{_PAREN}')) AS m FROM every), x AS (SELECT tinyId, regexp_extract(m, '{_PAREN}', 1) AS t, regexp_extract(m, '{_PAREN}', 2) AS a FROM m), {_ALIGN}"
_CATEGORY = r"CASE WHEN lower(expansion) = '' THEN 'unknown' WHEN regexp_matches(lower(expansion), '\b(questionnaire|scale|inventory|index|survey|checklist|battery|interview|test|form|schedule)\b') THEN 'instrument' WHEN regexp_matches(lower(expansion), '\b(study|trial|cohort|registry)\b') THEN 'study' WHEN regexp_matches(lower(expansion), '\b(institute|consortium|network|university|society)\b') THEN 'organization' ELSE 'medical_term' END"
_ABBREVIATIONS = _IN_PAREN + f", n AS (SELECT a, expansion, count(*) AS n FROM al GROUP BY 1, 2), b AS (SELECT a, expansion FROM n QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, expansion) = 1), k AS (SELECT a, count(DISTINCT tinyId) AS n_ids FROM al GROUP BY 1), ab AS (SELECT a AS abbreviation, expansion, n_ids, CAST(0.95 AS DOUBLE) AS confidence, {_CATEGORY} AS category FROM b JOIN k USING (a))"


@query("abbrev_parenthetical", with_texts(_ABBREVIATIONS + " SELECT * FROM ab"))
def _(spark, d):
    return ins.classify_abbreviations(ins.parenthetical(everything(spark, d)))


def _tag_sql(pattern: str, source: str, confidence: float, least: int, where: str = "true") -> str:
    return with_everything(f", a AS (SELECT tinyId, unnest(regexp_extract_all(text, '{pattern}', 1)) AS abbreviation FROM every WHERE {where}) SELECT abbreviation, '{source}' AS source, count(DISTINCT tinyId) AS n_ids, CAST({confidence} AS DOUBLE) AS confidence FROM a WHERE length(abbreviation) >= {least} GROUP BY 1")


@query("abbrev_bracketed", _tag_sql(ins.BRACKETED, "bracketed", 0.85, 2))
def _(spark, d):
    return ins.tagged(everything(spark, d), ins.BRACKETED, "bracketed", 0.85)


@query("abbrev_intercaps", _tag_sql(ins.INTERCAPS, "intercaps", 0.7, 3))
def _(spark, d):
    return ins.tagged(everything(spark, d), ins.INTERCAPS, "intercaps", 0.7, 3)


@query("abbrev_bare_caps", _tag_sql(ins.BARE_CAPS, "bare_caps", 0.5, 2, r"NOT (len(string_split_regex(trim(text), '\s+')) >= 2 AND len(list_filter(string_split_regex(trim(text), '\s+'), lambda t: regexp_full_match(t, '[A-Za-z]+') AND t <> upper(t))) = 0)"))
def _(spark, d):
    return ins.bare_capitals(everything(spark, d))


@query("abbrev_merge", f"WITH {_FOUND}, x AS (SELECT acronym AS abbreviation, count(*) AS n FROM f WHERE acronym IS NOT NULL GROUP BY 1) SELECT abbreviation, CASE WHEN n >= 3 THEN 'tentative_skip' ELSE 'skip' END AS decision, greatest(1, n) AS n_ids, CASE WHEN n >= 3 THEN 'grew 1 to ' || n END AS note FROM x")
def _(spark, d):
    n = _found(spark, d).where("acronym is not null").groupBy(F.col("acronym").alias("abbreviation")).agg(F.count("*").alias("n_ids"))
    old = n.select("abbreviation", F.lit("skip").alias("decision"), F.lit(1).cast("bigint").alias("n_ids"))
    return ins.merge_dictionaries(old, n.withColumn("decision", F.lit(None).cast("string")))


def _pattern_ids(spark, d):
    occ = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null").select("phrase_id", "tinyId").distinct()
    return table(spark, d, "phrases").select("phrase_id", F.col("text").alias("pattern")).join(occ, "phrase_id").select("pattern", "tinyId")


@query("merge_duplicates", "SELECT text AS pattern, count(DISTINCT tinyId) AS n_ids FROM phrases JOIN (SELECT DISTINCT phrase_id, tinyId FROM occurrences WHERE phrase_id IS NOT NULL AND tinyId IS NOT NULL) o USING (phrase_id) GROUP BY 1")
def _(spark, d):
    return pt.merge_duplicates(_pattern_ids(spark, d))


@query("merge_pattern_lists", "WITH r AS (SELECT pattern, coalesce(replace_with, '') AS replace_with, row_id AS o, 1 AS l, coalesce(trim(tinyIds), '') = '' AS u FROM substitute_patterns WHERE pattern IS NOT NULL UNION ALL SELECT pattern, '', row_id, 2, coalesce(trim(tinyIds), '') = '' FROM inst_full_patterns WHERE pattern IS NOT NULL) SELECT pattern, max_by(replace_with, l::VARCHAR || replace_with) AS replace_with, bool_or(u) AS universal FROM r GROUP BY 1")
def _(spark, d):
    universal = F.coalesce(F.trim("tinyIds"), F.lit("")) == ""
    a = table(spark, d, "substitute_patterns").where("pattern is not null").select("pattern", F.coalesce("replace_with", F.lit("")).alias("replace_with"), universal.alias("universal"))
    b = table(spark, d, "inst_full_patterns").where("pattern is not null").select("pattern", F.lit("").alias("replace_with"), universal.alias("universal"))
    return pt.merge_lists(a, b)


@query("coalesce_patterns")
def _(spark, d):
    return pt.coalesce(_pattern_ids(spark, d))


@query("greedy_prefix_cover")
def _(spark, d):
    t = F.split(F.lower("text"), " ")
    rows = table(spark, d, "phrases").select(F.col("phrase_id").alias("member"), F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(t))), lambda n: F.struct(F.least(n, F.size(t)).alias("k"), F.array_join(F.slice(t, 1, n), " ").alias("group")))).alias("g")).select("g.group", "g.k", "member")
    return pt.greedy_cover(rows.where("k >= 2"))


@query("anchor_expansion", "WITH p AS (SELECT DISTINCT pattern, regexp_replace(pattern, '^(?:as a part of|a field of|as part of|related to|based on|field of|from)(?:\\s+|$)', '', 'i') AS b FROM inst_full_patterns WHERE pattern IS NOT NULL) SELECT DISTINCT pattern, a || s || b AS anchored FROM p, unnest(['as a part of', 'a field of', 'as part of', 'related to', 'based on', 'field of', 'from']) x(a), unnest([' ', ' the ']) y(s)")
def _(spark, d):
    return pt.with_anchors(table(spark, d, "inst_full_patterns").where("pattern is not null").select("pattern"))


@query("temporal_seed_expansion")
def _(spark, d):
    return pt.expand(spark, gr.TEMPORAL_SEEDS, ["temporal", "plural", "number", "case", "punctuation"])


@query("verbatim_templates")
def _(spark, d):
    return vb.templates(table(spark, d, "occurrences"))


@query("verbatim_differences")
def _(spark, d):
    return vb.differences(table(spark, d, "occurrences"))


@query("verbatim_refined")
def _(spark, d):
    return vb.refine(table(spark, d, "occurrences").select("phrase_id", "verbatim_text", "tinyId"))


@query("lemma_surface_forms", "SELECT phrase_id, verbatim_text, count(*) AS n, count(DISTINCT tinyId) AS n_ids FROM occurrences WHERE phrase_id IS NOT NULL AND verbatim_text IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    return table(spark, d, "occurrences").where("phrase_id is not null and verbatim_text is not null").groupBy("phrase_id", "verbatim_text").agg(F.count("*").alias("n"), F.countDistinct("tinyId").alias("n_ids"))


_RANK = ", w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM texts), c AS (SELECT token, count(*) AS n FROM w GROUP BY 1), rk AS (SELECT token, CASE WHEN n >= 2 THEN row_number() OVER (ORDER BY n DESC, token) ELSE 0 END AS rank FROM c)"


@query("encode_tokens", with_texts(_RANK + ", t AS (SELECT tinyId, field_path, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token, generate_subscripts(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), 1) AS pos FROM texts) SELECT tinyId, array_to_string(list(rank ORDER BY field_path, pos), ' ') AS codes FROM t JOIN rk USING (token) GROUP BY 1"))
def _(spark, d):
    t = texts(spark, d)
    return en.encode(t, ag.vocabulary(t)).select("tinyId", F.array_join(F.transform("codes", lambda c: c.cast("string")), " ").alias("codes"))


@query("lemma_fasta")
def _(spark, d):
    t = texts(spark, d)
    coded = en.encode(t, ag.vocabulary(t))
    return en.fasta(coded.select("tinyId", en.to_base85(F.col("codes")).alias("code85")))
