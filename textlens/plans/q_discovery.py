"""Queries: discovery, masking, pruning, splits, suggestions, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.functions import text as tx
from textlens.operators import curation as cu, discovery as dc, instruments as ins, matching as mt, mining, stripping as sp
from textlens.operators import grouping as gr
from textlens.plans.corpus import everything, items, pattern_lists, texts, with_everything, with_items, with_texts
from textlens.plans.q_instruments import _ABBREVIATIONS
from textlens.plans.q_matching import ORACLES as MATCHING
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _patterns(spark, d):
    return table(spark, d, "phrases").select(F.col("text").alias("pattern")).where("pattern is not null").distinct()


@query("discover_verbatim")
def _(spark, d):
    return dc.discover(texts(spark, d), _patterns(spark, d))


@query("undiscovered_patterns")
def _(spark, d):
    return dc.undiscovered(_patterns(spark, d), dc.discover(texts(spark, d), _patterns(spark, d)))


@query("premasked_kmers")
def _(spark, d):
    names = table(spark, d, "instrument_match").select(F.col("instrument_name").alias("name")).unionByName(table(spark, d, "phrases").where("k >= 6").select(F.col("text").alias("name")))
    return mining.count_kmers(dc.mask_spans(mining.sequences(texts(spark, d)), names.where("name is not null")), 4)


_KINDS = "questionnaire|checklist|interview|inventory|schedule|battery|survey|index|scale|form"


@query("context_masking", with_everything(rf"SELECT tinyId, field_path, text, regexp_replace(text, '(?i)\b(?:{'|'.join(dc.pt.ANCHORS)})(?:\s+\S+){{{{0,5}}}}?\s+(?:{_KINDS})(?:\s*\([A-Z][A-Z0-9-]*\))?', '[MASK]', 'g') AS masked FROM every".replace("{{", "{").replace("}}", "}")))
def _(spark, d):
    return dc.mask_after(everything(spark, d).select("tinyId", "field_path", "text"), ["scale", "index", "inventory", "questionnaire", "survey", "interview", "checklist", "battery", "schedule", "form"])


@query("extended_spans", "SELECT row_id, regexp_extract(substr(pattern, 1, a), '" + dc.LEADING.replace("'", "''") + "', 0) || substr(pattern, a + 1, b - a) || regexp_extract(substr(pattern, b + 1), '" + dc.TRAILING.replace("'", "''") + "', 0) AS span FROM (SELECT row_id, pattern, length(regexp_extract(pattern, '^.*?([A-Za-z0-9]+)', 0)) - length(regexp_extract(pattern, '[A-Za-z0-9]+', 0)) AS a, length(regexp_extract(pattern, '^.*?([A-Za-z0-9]+)', 0)) AS b FROM inst_full_patterns WHERE pattern IS NOT NULL)")
def _(spark, d):
    # the first word of each pattern, with what touches it
    end = F.length(F.regexp_extract("pattern", "^.*?([A-Za-z0-9]+)", 0))
    start = end - F.length(F.regexp_extract("pattern", "[A-Za-z0-9]+", 0))
    return table(spark, d, "inst_full_patterns").where("pattern is not null").select("row_id", dc.extend_span(F.col("pattern"), start, end).alias("span"))


@query("whole_text_phrases", with_texts(", t AS (SELECT tinyId, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM texts) SELECT array_to_string(t, ' ') AS phrase, len(t) AS k, count(DISTINCT tinyId) AS n_ids FROM t WHERE len(t) > 25 GROUP BY 1, 2 HAVING count(DISTINCT tinyId) >= 2"))
def _(spark, d):
    return dc.whole_text_phrases(texts(spark, d))


_GRAMS = ", s AS (SELECT tinyId, field, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM texts), g AS (SELECT DISTINCT tinyId, field, array_to_string(t[i:i+n-1], ' ') AS phrase FROM s, unnest(range(1, len(t) + 1)) r(i), unnest([3, 4]) q(n) WHERE i + n - 1 <= len(t))"


@query("prune_global", with_texts(_GRAMS + ", c AS (SELECT DISTINCT field, unnest([array_to_string(string_split(phrase, ' ')[1:3], ' '), array_to_string(string_split(phrase, ' ')[2:4], ' ')]) AS phrase FROM g WHERE len(string_split(phrase, ' ')) = 4) SELECT g.field, g.phrase, count(*) AS n_ids FROM g ANTI JOIN c ON c.field = g.field AND c.phrase = g.phrase GROUP BY 1, 2"))
def _(spark, d):
    return dc.prune(mining.ngrams(texts(spark, d), 3, 4).distinct()).groupBy("field", "phrase").agg(F.count("*").alias("n_ids"))


@query("prune_by_record", with_texts(_GRAMS + ", c AS (SELECT DISTINCT tinyId, field, unnest([array_to_string(string_split(phrase, ' ')[1:3], ' '), array_to_string(string_split(phrase, ' ')[2:4], ' ')]) AS phrase FROM g WHERE len(string_split(phrase, ' ')) = 4) SELECT g.field, g.phrase, count(*) AS n_ids FROM g ANTI JOIN c ON c.field = g.field AND c.phrase = g.phrase AND c.tinyId = g.tinyId GROUP BY 1, 2"))
def _(spark, d):
    return dc.prune(mining.ngrams(texts(spark, d), 3, 4).distinct(), "tinyid").groupBy("field", "phrase").agg(F.count("*").alias("n_ids"))


def _acronyms(spark, d):
    return table(spark, d, "instrument_match").where("acronym is not null and tinyId is not null").select(F.upper(F.regexp_replace("acronym", r"[()\[\] ]", "")).alias("abbreviation"))


def _matches(spark, d):
    return table(spark, d, "instrument_match").where("full_match is not null and tinyId is not null").select("tinyId", F.lit("definition").alias("field"), "field_path", F.col("full_match").alias("text"))


@query("abbreviation_subset_mining", with_everything(r", a AS (SELECT DISTINCT upper(regexp_replace(acronym, '[()\[\] ]', '', 'g')) AS abbreviation FROM instrument_match WHERE acronym IS NOT NULL AND tinyId IS NOT NULL), h AS (SELECT a.abbreviation, e.tinyId, regexp_extract_all(lower(e.text), '[\p{L}\p{N}]+') AS t FROM every e JOIN a ON a.abbreviation <> '' AND contains(e.text, a.abbreviation)), g AS (SELECT DISTINCT abbreviation, tinyId, k, array_to_string(t[i:i+k-1], ' ') AS phrase FROM h, unnest(range(3, 9)) q(k), unnest(range(1, len(t) + 1)) r(i) WHERE i + k - 1 <= len(t)), n AS (SELECT abbreviation, CAST(k AS INT) AS k, phrase, count(*) AS n_ids FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 2) SELECT abbreviation, k, phrase, n_ids, CAST(row_number() OVER (PARTITION BY abbreviation ORDER BY k DESC, n_ids DESC, phrase) AS INT) AS rank FROM n QUALIFY rank <= 10"))
def _(spark, d):
    return dc.mine_subset(everything(spark, d), _acronyms(spark, d).distinct(), k_max=8, k_min=3)


@query("abbreviation_patterns", with_everything(r", a AS (SELECT DISTINCT upper(regexp_replace(acronym, '[()\[\] ]', '', 'g')) AS abbreviation FROM instrument_match WHERE acronym IS NOT NULL AND tinyId IS NOT NULL), x AS (SELECT tinyId, 'bracketed' AS form, unnest(regexp_extract_all(text, '\[([A-Z][A-Z0-9\-]+)\]', 1)) AS abbreviation FROM every UNION ALL SELECT tinyId, 'leading', unnest(regexp_extract_all(text, '^([A-Z][A-Z0-9\-]+)\s+[-–]\s', 1)) FROM every UNION ALL SELECT tinyId, 'parenthesised', unnest(regexp_extract_all(text, '\(([A-Z][A-Z0-9\-]+)\)', 1)) FROM every) SELECT abbreviation, form, count(DISTINCT tinyId) AS n_ids FROM x SEMI JOIN a USING (abbreviation) GROUP BY 1, 2"))
def _(spark, d):
    return dc.abbreviation_patterns(everything(spark, d), _acronyms(spark, d))


@query("abbreviation_export", with_texts(_ABBREVIATIONS + " SELECT abbreviation, expansion, CASE WHEN category IN ('instrument', 'study') AND confidence >= 0.8 THEN 'strip' WHEN category IN ('instrument', 'study', 'unknown') THEN 'review' ELSE 'skip' END AS target FROM ab"))
def _(spark, d):
    entries = ins.classify_abbreviations(ins.parenthetical(everything(spark, d))).withColumn("decision", F.lit(None).cast("string"))
    return dc.export_abbreviations(entries)


@query("field_analysis", MATCHING["field_profile"].removesuffix(" FROM dist").replace(" SELECT *, CASE", ", e AS (SELECT pattern, first(field_path ORDER BY field_path, tinyId, text) AS example_field, first(text ORDER BY field_path, tinyId, text) AS example_text FROM hits GROUP BY 1) SELECT dist.*, CASE") .replace(" AS profile", " AS profile, e.example_field, e.example_text FROM dist JOIN e USING (pattern)"))
def _(spark, d):
    return dc.field_analysis(mt.literal_hits(texts(spark, d), _patterns(spark, d)))


_SPLIT = r"n AS (SELECT DISTINCT pattern AS name, trim(regexp_replace(pattern, '\s*\(([A-Z][A-Z0-9\-]+)\)', '', 'g')) AS bare, nullif(regexp_extract(pattern, '\(([A-Z][A-Z0-9\-]+)\)', 1), '') AS abbreviation FROM inst_full_patterns WHERE pattern IS NOT NULL)"


@query("instrument_splits", f"WITH {_SPLIT} SELECT name, bare AS full, CAST(NULL AS VARCHAR) AS sub, abbreviation FROM n".replace("bare AS full, CAST(NULL AS VARCHAR) AS sub", r"trim(string_split_regex(bare, '\s+[-–]\s+|:\s+')[1]) AS full, trim(string_split_regex(bare, '\s+[-–]\s+|:\s+')[2]) AS sub").replace(" AS full", ' AS "full"'))
def _(spark, d):
    return dc.splits(table(spark, d, "inst_full_patterns").where("pattern is not null").select(F.col("pattern").alias("name")).distinct())


@query("strip_pattern_generation", f"WITH {_SPLIT}, c AS (SELECT name, abbreviation, bare, trim(string_split_regex(bare, '\\s+[-–]\\s+|:\\s+')[1]) AS f, trim(string_split_regex(bare, '\\s+[-–]\\s+|:\\s+')[2]) AS s FROM n), k AS (SELECT name, abbreviation, CASE WHEN regexp_matches(s, '(?i)^(?:of|for|in|on|at|by|to)\\b') THEN bare ELSE f END AS f, CASE WHEN regexp_matches(s, '(?i)^(?:of|for|in|on|at|by|to)\\b') THEN NULL ELSE s END AS s FROM c), d AS (SELECT pattern AS name, min(decision) AS decision FROM inst_full_patterns WHERE pattern IS NOT NULL GROUP BY 1), p AS (SELECT unnest(['full', 'sub', 'abbreviation']) AS kind, unnest([f, s, abbreviation]) AS p FROM k JOIN d USING (name) WHERE lower(trim(coalesce(decision, ''))) IN ('', 'keep', 'strip', 'approve', 'modify')) SELECT DISTINCT CASE WHEN kind = 'abbreviation' OR len(list_filter(string_split_regex(p, '\\s+'), lambda w: w <> '')) < 3 THEN 'REGEX:\\b' || regexp_replace(p, '([.^$*+?()\\[\\]{{}}|\\\\])', '\\\\\\1', 'g') || '\\b' ELSE p END AS pattern, kind FROM p WHERE p IS NOT NULL AND p <> ''")
def _(spark, d):
    p = table(spark, d, "inst_full_patterns").where("pattern is not null").select(F.col("pattern").alias("name"), "decision", F.lit(None).cast("string").alias("modification"))
    return dc.strip_patterns(dc.splits(p.select("name").distinct()), p.groupBy("name").agg(F.min("decision").alias("decision"), F.min("modification").alias("modification")))


@query("supplementary_instruments", with_everything(", n AS (SELECT instrument_name AS name, min(acronym) AS acronym FROM instrument_match WHERE instrument_name IS NOT NULL GROUP BY 1) SELECT DISTINCT tinyId, field_path, name, acronym FROM every JOIN n ON name <> '' AND contains(text, name)"))
def _(spark, d):
    m = table(spark, d, "instrument_match").where("instrument_name is not null")
    names = m.select(F.col("instrument_name").alias("name"), "acronym").groupBy("name").agg(F.min("acronym").alias("acronym"))
    return dc.supplementary(everything(spark, d), names)


@query("recall_suggestions", r"WITH h AS (SELECT DISTINCT tinyId FROM instrument_match WHERE tinyId IS NOT NULL), m AS (SELECT DISTINCT verbatim_text AS text FROM occurrences o WHERE verbatim_text IS NOT NULL AND tinyId IS NOT NULL AND tinyId NOT IN (SELECT tinyId FROM h)), t AS (SELECT string_split_regex(lower(trim(text)), '\s+') AS t FROM m), n AS (SELECT array_to_string(t[1:3], ' ') AS prefix, count(*) AS n FROM t WHERE len(t) >= 3 GROUP BY 1 HAVING count(*) >= 2) SELECT prefix, n, '(?i)\b' || regexp_replace(regexp_replace(prefix, '([.^$*+?()\[\]{}|\\])', '\\\1', 'g'), '[\s\-]+', '[-\\s]+', 'g') || '\b' AS regex FROM n")
def _(spark, d):
    seen = table(spark, d, "instrument_match").where("tinyId is not null").select("tinyId").distinct()
    missing = table(spark, d, "occurrences").where("verbatim_text is not null and tinyId is not null").join(seen, "tinyId", "left_anti").select(F.col("verbatim_text").alias("text")).distinct()
    return dc.suggest(missing)


@query("classify_phrases", r"SELECT DISTINCT phrase_id, CASE WHEN regexp_matches(text, '(?i)\b(past|previous|last|since|baseline)\b') THEN 'temporal' WHEN regexp_matches(text, '(?i)\b(battery|scale|index)\b') THEN 'instrument' ELSE 'other' END AS category, CASE WHEN regexp_matches(text, '(?i)\b(past|previous|last|since|baseline|battery|scale|index)\b') THEN 0.9 ELSE 0.3 END AS confidence, 'unanimous' AS agreement FROM (SELECT phrase_id, text FROM phrases WHERE phrase_id IS NOT NULL QUALIFY count(DISTINCT text) OVER (PARTITION BY phrase_id) = 1)")
def _(spark, d):
    client = dc.keyword_client({"temporal": r"\b(past|previous|last|since|baseline)\b", "instrument": r"\b(battery|scale|index)\b"}, "other")
    p = table(spark, d, "phrases").where("phrase_id is not null")
    one = p.groupBy("phrase_id").agg(F.countDistinct("text").alias("n")).where("n = 1")  # an id of several texts is no phrase
    got = dc.classify_batches(p.join(one, "phrase_id").select("phrase_id", "text").distinct(), client, ["temporal", "instrument", "other"])
    return cu.votes(got.withColumn("weight", F.lit(1.0)))


@query("variant_rows", "SELECT tinyId, field_path, variant, text FROM (UNPIVOT (" + MATCHING["variants_7"] + ") ON MTSFPF, MFSTPF, MTSTPF, MFSFPT, MTSFPT, MFSTPT, MTSTPT INTO NAME variant VALUE text)")
def _(spark, d):
    from textlens.plans.q_matching import QUERIES as M

    return dc.variant_rows(M["variants_7"](spark, d), list(sp.STAGES), ["tinyId", "field_path"])


@query("reference_text", with_items("SELECT tinyId, coalesce(array_to_string(list_filter([regexp_replace(trim(coalesce(nullif(x.designation, ''), CAST(NULL AS VARCHAR))), ' {2,}', ' ', 'g') FOR x IN designations], lambda s: s IS NOT NULL AND s <> ''), ';; '), '') AS docs FROM items"))
def _(spark, d):
    docs = F.transform("designations", lambda x: F.struct(x["designation"].alias("document"), F.lit(None).cast("string").alias("text")))
    return items(spark, d, "designations").select("tinyId", F.coalesce(dc.reference_text(docs), F.lit("")).alias("docs"))


_LEMMA = "CASE " + " ".join(f"WHEN surface = '{a}' THEN '{b}'" for a, b in dc._IRREGULAR.items()) + r" WHEN regexp_matches(surface, '(?:ss|us|is)$') OR length(surface) < 4 THEN surface WHEN regexp_matches(surface, 'ies$') AND length(surface) > 4 THEN regexp_replace(surface, 'ies$', 'y') WHEN regexp_matches(surface, '(?:ches|shes|sses|xes|zes)$') THEN regexp_replace(surface, 'es$', '') WHEN regexp_matches(surface, '[^s]s$') THEN regexp_replace(surface, 's$', '') WHEN regexp_matches(surface, '[b-df-hj-np-tv-z]{2}ing$|[aeiou][a-z]+[aeiou][a-z]ing$') THEN regexp_replace(surface, 'ing$', '') ELSE surface END"


@query("lemma_forms", with_texts(r", w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS surface FROM texts) SELECT surface, count(*) AS n, " + _LEMMA + " AS lemma FROM w GROUP BY 1"))
def _(spark, d):
    t = texts(spark, d).select(F.explode(tx.tokens(F.col("text"))).alias("surface"))
    return t.groupBy("surface").agg(F.count("*").alias("n")).withColumn("lemma", dc.lemma(F.col("surface")))
