"""Queries: longest phrases, coalescing in all phases, ledgers and sections, abbreviations in context, runs of several steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.functions import paths, text as tx
from textlens.operators import aggregates as ag, curation as cu, discovery as dc, encoding as en, fields, filters, grouping as gr, instruments as ins, ledger as lg, matching as mt, mining, patterns as pt, stripping as st, verbatim as vb
from textlens.plans.corpus import SQL_EVERYTHING, items, pattern_lists, texts, with_items, with_texts
from textlens.plans.q_curation import ORACLES as CURATION
from textlens.plans.q_discovery import _LEMMA
from textlens.plans.q_groups import _LABELS, _NAMES, _TC
from textlens.plans.q_instruments import _ALIGN, _PAREN
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


def _phrases(spark, d):
    return table(spark, d, "phrases").select(F.col("text").alias("pattern")).where("pattern is not null").distinct()


def _matches(spark, d):
    return table(spark, d, "instrument_match").where("full_match is not null and tinyId is not null").select("tinyId", F.lit("definition").alias("field"), "field_path", F.col("full_match").alias("text"))


def _everything(spark, d):
    return texts(spark, d).select("tinyId", "field", "field_path", "text").unionByName(_matches(spark, d))


# ---- mining


@query("mined_occurrences")
def _(spark, d):
    return mining.mine_occurrences(texts(spark, d)).occurrences


@query("mined_variants")
def _(spark, d):
    return mining.verbatim_variants(mining.mine_occurrences(texts(spark, d)))


_K4 = ", s AS (SELECT tinyId, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM texts), g AS (SELECT tinyId, array_to_string(t[i:i+n-1], ' ') AS phrase, n AS k FROM s, unnest(range(1, len(t) + 1)) r(i), unnest([3, 4, 5]) q(n) WHERE i + n - 1 <= len(t)), c AS (SELECT phrase, k, count(*) AS count FROM g GROUP BY 1, 2 HAVING count(*) >= 3 AND count(DISTINCT tinyId) >= 2)"


def _kmers(spark, d, sizes):
    seqs = mining.sequences(texts(spark, d))
    parts = [mining.count_kmers(seqs, k).select(F.col("kmer").alias("phrase"), F.lit(k).alias("k"), F.col("freq").alias("count")) for k in sizes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("prune_contained", with_texts(_K4 + ", x AS (SELECT DISTINCT count, unnest(list_concat([array_to_string(string_split(phrase, ' ')[i:i+2], ' ') FOR i IN range(1, k - 1)], CASE WHEN k = 5 THEN [array_to_string(string_split(phrase, ' ')[1:4], ' '), array_to_string(string_split(phrase, ' ')[2:5], ' ')] ELSE [] END)) AS phrase FROM c WHERE k > 3) SELECT phrase, k, count FROM c ANTI JOIN x USING (count, phrase)"))
def _(spark, d):
    return gr.prune_contained(_kmers(spark, d, (3, 4, 5)))


@query("longest_phrases")
def _(spark, d):
    return gr.longest_phrases(_kmers(spark, d, (4,)).select(F.col("phrase").alias("kmer"), "count"))


@query("merged_phrases")
def _(spark, d):
    return gr.merge_overlapping(_kmers(spark, d, (6,)).select("phrase", "count"))


@query("residual_text")
def _(spark, d):
    return dc.residual_text(texts(spark, d), _phrases(spark, d).select(F.col("pattern").alias("name")))


# ---- patterns


def _pattern_ids(spark, d):
    occ = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null").select("phrase_id", "tinyId").distinct()
    return table(spark, d, "phrases").select("phrase_id", F.col("text").alias("pattern")).join(occ, "phrase_id").select("pattern", "tinyId")


@query("coalesce_all_phases")
def _(spark, d):
    n = _pattern_ids(spark, d)
    parents = table(spark, d, "substitute_patterns").where("pattern is not null").select("pattern", "parent_phrase", F.coalesce("parent_tinyid_count", F.lit(0)).alias("parent_tinyid_count"))
    own = parents.unionByName(n.groupBy("pattern").agg(F.lit("").alias("parent_phrase"), F.countDistinct("tinyId").cast("int").alias("parent_tinyid_count")))
    return pt.coalesce(n, own, least_parent_ids=2, least_actual_ids=5, defer=True, roll=True, least_prefix_ids=3, definition_forms=True)


_BARE = r"SELECT DISTINCT pattern, trim(coalesce(nullif(regexp_extract(pattern, '^(?is)(?:.*?\b)?(?:as a part of|a field of|as part of|related to|based on|field of|from)\s+(?:version\s+[\d.]+\s+of\s+)?(?:(?:the|a|an)\s+)?(\S.*)$', 1), ''), pattern)) AS bare FROM inst_full_patterns WHERE pattern IS NOT NULL"


@query("bare_names", _BARE)
def _(spark, d):
    return table(spark, d, "inst_full_patterns").where("pattern is not null").select("pattern", pt.bare_column(F.col("pattern")).alias("bare")).distinct()


@query("core_names", f"WITH b AS ({_BARE}) SELECT DISTINCT bare, coalesce(nullif(regexp_extract(bare, '^(.+?)\\s*\\([^)]+\\)$', 1), ''), bare) AS core, nullif(regexp_extract(bare, '^.+?\\s*\\(([^)]+)\\)$', 1), '') AS acronym FROM b")
def _(spark, d):
    bare = table(spark, d, "inst_full_patterns").where("pattern is not null").select(pt.bare_column(F.col("pattern")).alias("bare")).distinct()
    return bare.select("bare", pt.core_column(F.col("bare")).alias("c")).select("bare", "c.core", "c.acronym").distinct()


@query("pattern_tiers", "SELECT DISTINCT text AS pattern, CASE WHEN len(string_split_regex(trim(text), '\\s+')) >= 3 THEN 'long' ELSE 'short' END AS tier FROM phrases WHERE text IS NOT NULL")
def _(spark, d):
    return pt.tiers(_phrases(spark, d))


@query("cross_acronyms", f"WITH b AS ({_BARE}), c AS (SELECT DISTINCT bare AS pattern, coalesce(nullif(regexp_extract(bare, '^(.+?)\\s*\\([^)]+\\)$', 1), ''), bare) AS core, nullif(regexp_extract(bare, '^.+?\\s*\\(([^)]+)\\)$', 1), '') AS acronym FROM b), a AS (SELECT DISTINCT lower(core) AS k, acronym AS a FROM c WHERE acronym IS NOT NULL), v AS (SELECT pattern, unnest([core || ' (' || a || ')', core || ' (' || a || ') -', a || ' - ' || core]) AS variant FROM c JOIN a ON a.k = lower(c.core)) SELECT DISTINCT pattern, variant FROM v WHERE variant <> pattern")
def _(spark, d):
    bare = table(spark, d, "inst_full_patterns").where("pattern is not null").select(pt.bare_column(F.col("pattern")).alias("pattern")).distinct()
    return pt.cross_acronyms(bare)


@query("discovery_run")
def _(spark, d):
    p = _phrases(spark, d).unionByName(table(spark, d, "inst_full_patterns").where("pattern is not null").select("pattern"))
    parents = table(spark, d, "substitute_patterns").where("pattern is not null").select("pattern", "parent_phrase")
    return dc.discovery_run(_everything(spark, d), p, parents)


@query("discover_and_strip")
def _(spark, d):
    return st.discover_and_strip(texts(spark, d), _phrases(spark, d)).select("tinyId", "field_path", "stripped")


_LITERAL = r"p AS (SELECT DISTINCT pattern FROM inst_full_patterns WHERE pattern IS NOT NULL AND pattern <> '')"
_ALL = ", every AS (SELECT tinyId, text FROM texts UNION ALL SELECT tinyId, full_match FROM instrument_match WHERE full_match IS NOT NULL AND tinyId IS NOT NULL)"


@query("rematch_patterns", with_texts(_ALL + f", {_LITERAL} SELECT pattern, count(DISTINCT tinyId) AS n_ids FROM every JOIN p ON contains(text, pattern) GROUP BY 1 UNION ALL SELECT 'REGEX:\\b' || a || '\\b', count(DISTINCT tinyId) FROM every JOIN (SELECT DISTINCT acronym AS a FROM instrument_match WHERE regexp_full_match(acronym, '[A-Z]{{2,8}}')) ON regexp_matches(text, '(?:^|[^A-Za-z0-9_])' || a || '(?:$|[^A-Za-z0-9_])') GROUP BY 1"))
def _(spark, d):
    p = table(spark, d, "inst_full_patterns").where("pattern is not null and pattern <> ''").select("pattern")
    a = table(spark, d, "instrument_match").where("acronym rlike '^[A-Z]{2,8}$'").select(F.concat(F.lit("REGEX:\\b"), "acronym", F.lit("\\b")).alias("pattern"))
    return dc.rematch(_everything(spark, d), p.unionByName(a))


# ---- ledger and sections


_TWO = r"one AS (SELECT pattern, list_filter(string_split_regex(regexp_replace(coalesce(tinyIds, ''), '[\[\]\"'']', '', 'g'), '[\s|,;]+'), lambda x: x <> '') AS ids, 'substitute' AS source FROM substitute_patterns WHERE pattern IS NOT NULL), two AS (SELECT pattern, list_filter(string_split_regex(regexp_replace(coalesce(tinyIds, ''), '[\[\]\"'']', '', 'g'), '[\s|,;]+'), lambda x: x <> '') AS ids, coalesce(source, 'none') AS source FROM inst_full_patterns WHERE pattern IS NOT NULL)"


@query("pattern_ledger", f"WITH {_TWO}, i AS (SELECT pattern, unnest(ids) AS id FROM one UNION SELECT pattern, unnest(ids) FROM two), n AS (SELECT pattern, string_agg(DISTINCT id, ' ' ORDER BY id) AS ids FROM i GROUP BY 1), a AS (SELECT pattern, min(source) AS s FROM one GROUP BY 1), b AS (SELECT pattern, min(source) AS s FROM two GROUP BY 1) SELECT pattern, coalesce(n.ids, '') AS ids, coalesce(a.s, b.s) AS source, CASE WHEN a.s IS NULL THEN 2 ELSE 1 END AS first_round, CASE WHEN b.s IS NULL THEN 1 ELSE 2 END AS last_round, CASE WHEN a.s IS NOT NULL AND b.s IS NOT NULL THEN 'seen' ELSE 'new' END AS status FROM a FULL JOIN b USING (pattern) LEFT JOIN n USING (pattern)")
def _(spark, d):
    lists = pattern_lists(spark, d)
    one = lists["substitute"].select(F.col("phrase").alias("pattern"), "ids", F.lit("substitute").alias("source"))
    two = table(spark, d, "inst_full_patterns").where("pattern is not null").select("row_id", F.coalesce("source", F.lit("none")).alias("source")).join(lists["inst_full"].select(F.col("file_ord").alias("row_id"), F.col("phrase").alias("pattern"), "ids"), "row_id").drop("row_id")
    empty = spark.createDataFrame([], "pattern string, ids array<string>, source string, first_round int, last_round int, status string")
    return lg.update(lg.update(empty, one, 1), two, 2).withColumn("ids", F.array_join("ids", " "))


_SECTION = "CASE " + " ".join(f"WHEN regexp_matches(lower({{0}}), '\\b(?:{w})\\b') THEN '{s}'" for s, w in lg.SECTIONS.items()) + " ELSE 'other' END"
_HARVEST = MATCHING["residual_harvest"]


@query("supplementary_sections", f"SELECT {_SECTION.format('phrase')} AS section, array_to_string(list_filter(string_split_regex(lower(phrase), '[^a-z0-9]+'), lambda w: w <> '')[1:5], '_') AS name, phrase AS pattern FROM ({_HARVEST}) WHERE status = 'new_candidate'")
def _(spark, d):
    return lg.to_sections(mt.harvest(table(spark, d, "verbatim_variants").where("lemma is not null").select(F.col("lemma").alias("phrase")), table(spark, d, "phrases").select(F.col("text").alias("pattern")).distinct()))


@query("section_additions", "WITH a AS (SELECT DISTINCT 'x' AS section, 'n' AS name, lower(text) AS pattern FROM phrases WHERE text IS NOT NULL AND k >= 5), b AS (SELECT 'x' AS section, 'n' AS name, min(text) AS pattern FROM phrases WHERE text IS NOT NULL GROUP BY lower(text)) SELECT section, name, lower(pattern) AS pattern FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE lower(pattern) NOT IN (SELECT pattern FROM a))")
def _(spark, d):
    p = table(spark, d, "phrases").where("text is not null")
    held = p.where("k >= 5").select(F.lit("x").alias("section"), F.lit("n").alias("name"), F.lower("text").alias("pattern")).distinct()
    return lg.add(held, p.select(F.lit("x").alias("section"), F.lit("n").alias("name"), F.col("text").alias("pattern"))).withColumn("pattern", F.lower("pattern"))


_N = "SELECT verbatim_text AS pattern, count(DISTINCT tinyId) AS n_ids FROM occurrences WHERE verbatim_text IS NOT NULL AND tinyId IS NOT NULL GROUP BY 1"


@query("promoted_patterns", f"WITH n AS ({_N}), g AS (SELECT text AS pattern, max(coalesce(n_tinyids, 0)) AS n_ids FROM phrases WHERE text IS NOT NULL GROUP BY 1), u AS (SELECT * FROM g UNION ALL SELECT * FROM n WHERE n_ids >= 5) SELECT 'general' AS list, pattern, CAST(max(n_ids) AS BIGINT) AS n_ids FROM u GROUP BY 2 UNION ALL SELECT 'local', pattern, n_ids FROM n WHERE n_ids < 5")
def _(spark, d):
    o = table(spark, d, "occurrences").where("verbatim_text is not null and tinyId is not null").groupBy(F.col("verbatim_text").alias("pattern")).agg(F.countDistinct("tinyId").alias("n_ids"))
    g = table(spark, d, "phrases").where("text is not null").groupBy(F.col("text").alias("pattern")).agg(F.max(F.coalesce("n_tinyids", F.lit(0))).cast("bigint").alias("n_ids"))
    up, rest = lg.promote(o, g)
    return up.select(F.lit("general").alias("list"), "pattern", "n_ids").unionByName(rest.select(F.lit("local").alias("list"), "pattern", "n_ids"))


@query("residual_suggestions", f"WITH r AS ({MATCHING['anchor_residue']}), c AS (SELECT context, max(n_ids) AS n_ids FROM r GROUP BY 1) SELECT {_SECTION.format('context')} AS section, '- pattern: ''' || replace(context, '''', '''''') || '''  # records: ' || n_ids AS entry FROM c WHERE n_ids >= 2")
def _(spark, d):
    return lg.suggestions(mt.anchor_residue(texts(spark, d)).groupBy("context").agg(F.max("n_ids").alias("n_ids")))


# ---- misses


@query("family_misses", "WITH w AS (SELECT DISTINCT phrase_id AS family, tinyId FROM occurrences WHERE phrase_id IS NOT NULL AND tinyId IS NOT NULL) SELECT family, count(*) AS n_missed, min(tinyId) AS example FROM w WHERE tinyId NOT IN (SELECT tinyId FROM instrument_match WHERE tinyId IS NOT NULL) GROUP BY 1")
def _(spark, d):
    w = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null").select(F.col("phrase_id").alias("family"), "tinyId")
    return mt.family_misses(w, table(spark, d, "instrument_match").where("tinyId is not null"))


_ANCH = "|".join(mt.ANCHORS)


@query("anchor_misses", with_texts(rf", m AS (SELECT tinyId, unnest(regexp_extract_all(lower(text), '\b(?:{_ANCH})\s+(?:the\s+)?[^.;!?,]{{3,60}}')) AS m FROM texts WHERE tinyId NOT IN (SELECT tinyId FROM instrument_match WHERE tinyId IS NOT NULL)) SELECT regexp_extract(m, '^({_ANCH})', 1) AS anchor, trim(regexp_replace(regexp_replace(m, '^(?:{_ANCH})', ''), '\s+', ' ', 'g')) AS context, count(DISTINCT tinyId) AS n_ids FROM m GROUP BY 1, 2"))
def _(spark, d):
    return mt.anchor_misses(texts(spark, d), table(spark, d, "instrument_match").where("tinyId is not null"))


_RARE = MATCHING["rare_words"]


@query("rare_words_allowed", f"SELECT * FROM ({_RARE}) WHERE lower(word) NOT IN (SELECT lower(unnest(string_split(text, ' '))) FROM phrases WHERE text IS NOT NULL)")
def _(spark, d):
    allowed = table(spark, d, "phrases").where("text is not null").select(F.explode(F.split("text", " ")).alias("word"))
    return dc.rare_but_listed(mt.rare_words(texts(spark, d), most_zipf=5.0), allowed)


# ---- instruments and abbreviations


@query("instruments_three_passes")
def _(spark, d):
    m = table(spark, d, "instrument_match").where("instrument_name is not null").groupBy(F.col("instrument_name").alias("name")).agg(F.min("acronym").alias("acronym"))
    return ins.three_passes(_everything(spark, d), m)


_CONTEXT = SQL_EVERYTHING + f", m AS (SELECT tinyId, field_path, unnest(regexp_extract_all(text, '{_PAREN}')) AS m, generate_subscripts(regexp_extract_all(text, '{_PAREN}'), 1) AS place FROM every), p AS (SELECT tinyId, field_path, place, regexp_extract(m, '{_PAREN}', 1) AS t, regexp_extract(m, '{_PAREN}', 2) AS a FROM m), sn AS (SELECT DISTINCT tinyId, unnest(regexp_extract_all(text, '\\(([A-Z][A-Z0-9-]+)\\)', 1)) AS a FROM every), x AS (SELECT p.* FROM p SEMI JOIN sn ON sn.tinyId = p.tinyId AND sn.a = p.a QUALIFY row_number() OVER (PARTITION BY p.a ORDER BY p.tinyId, field_path, place, t) = 1), {_ALIGN}"


@query("abbreviations_in_context", with_texts(_CONTEXT + " SELECT a AS abbreviation, expansion, 'context' AS source FROM al"))
def _(spark, d):
    t = _everything(spark, d)
    seen = t.select("tinyId", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\(([A-Z][A-Z0-9-]+)\)"), F.lit(1)))).alias("abbreviation"))
    return ins.context_expansions(t, seen)


@query("abbreviation_pipeline")
def _(spark, d):
    m = table(spark, d, "instrument_match").where("instrument_name is not null").select("tinyId", "instrument_name", F.upper(F.regexp_replace("acronym", r"[()\[\] ]", "")).alias("acronym"))
    return ins.abbreviation_pipeline(_everything(spark, d), ins.acronym_names(m))


@query("sub_instruments", r"SELECT DISTINCT instrument_name AS name, regexp_replace(regexp_replace(lower(trim(string_split_regex(trim(instrument_name), '\s+[-–]\s+|:\s+')[1])), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS instrument_id, nullif(trim(CASE WHEN len(string_split_regex(trim(instrument_name), '\s+[-–]\s+|:\s+')) > 1 THEN regexp_replace(trim(instrument_name), '^.*?(?:\s+[-–]\s+|:\s+)', '') ELSE '' END), '') AS sub_instrument FROM instrument_match WHERE instrument_name IS NOT NULL")
def _(spark, d):
    return table(spark, d, "instrument_match").where("instrument_name is not null").select(F.col("instrument_name").alias("name"), ins.sub_instrument(F.col("instrument_name")).alias("x")).select("name", "x.*").distinct()


@query("token_spans", with_texts(r", s AS (SELECT tinyId, field_path, text, strpos(lower(text), 'since the last visit') - 1 AS a FROM texts WHERE contains(lower(text), 'since the last visit')) SELECT tinyId, field_path, CAST(a AS INT) AS char_start, CAST(a + 20 AS INT) AS char_end, CAST(len(regexp_extract_all(substr(text, 1, a), '[\p{L}\p{N}]+')) AS INT) AS token_start, CAST(len(regexp_extract_all(substr(text, 1, a), '[\p{L}\p{N}]+')) + 4 AS INT) AS token_end FROM s WHERE NOT regexp_matches(substr(text, 1, a), '[\p{L}\p{N}]$') AND NOT regexp_matches(substr(text, a + 21), '^[\p{L}\p{N}]')"))
def _(spark, d):
    t = texts(spark, d)
    at = F.instr(F.lower("text"), F.lit("since the last visit")) - 1
    s = t.where(at >= 0).select("tinyId", "field_path", at.cast("int").alias("char_start"), (at + 20).cast("int").alias("char_end"), F.substring("text", F.lit(1), at).alias("l"), F.substring("text", at + 21, F.length("text")).alias("r"))
    return ins.token_spans(t, s.where(r"not l rlike '[\\p{L}\\p{N}]$' and not r rlike '^[\\p{L}\\p{N}]'"))


_FRAMED = _TC.replace("lower(text)", "lower(name)")
_NORMAL = r"regexp_replace(regexp_replace(lower(name), '\b(?:in|over|during|within) the (?:past|last|previous)\b', 'in the past', 'g'), '\bin the past (hour|day|week|month|year)\b', 'in the past 1 \1', 'g')"


@query("semantic_groups", f"WITH {_NAMES}, {_LABELS}, fr AS (SELECT name, {_FRAMED} AS frame, {_NORMAL} AS normal FROM r), a AS (SELECT fr.name, CASE WHEN frame = 'none' THEN group_label ELSE 'time: ' || normal END AS group_label, frame, false AS generated FROM fr JOIN gl USING (name)), i AS (SELECT DISTINCT regexp_replace(normal, '\\bin the past 1 ', 'in the past ') AS name, 'time: ' || normal AS group_label, frame, true AS generated FROM fr WHERE regexp_matches(normal, '\\bin the past 1 (?:hour|day|week|month|year)\\b')) SELECT * FROM a UNION ALL SELECT * FROM i WHERE name NOT IN (SELECT lower(name) FROM r)")
def _(spark, d):
    return gr.semantic_groups(table(spark, d, "phrases").select(F.col("text").alias("name")))


# ---- fields, clean-up, encoding


@query("renamed_for_embedding", with_items("SELECT tinyId, designations[1].designation AS name, designations[2].designation AS question, definitions[1].definition AS definition FROM items"))
def _(spark, d):
    df = items(spark, d, "designations", "definitions")
    return fields.renamed(df.select("tinyId", paths.get(df, "designations.0.designation").alias("Name"), paths.get(df, "designations.1.designation").alias("Question"), paths.get(df, "definitions.0.definition").alias("Definition")))


_PLAIN = lambda c: rf"trim(regexp_replace(regexp_replace(regexp_replace(trim(coalesce({c}, '')), '\r\n?', chr(10), 'g'), '\n+', ' ', 'g'), ' {{2,}}', ' ', 'g'))"


@query("joined_objects", with_items(f"SELECT tinyId, coalesce(array_to_string(list_filter([{_PLAIN('x.permissibleValue')} FOR x IN valueDomain.permissibleValues], lambda s: s <> ''), ';; '), '') AS values_, coalesce(array_to_string(list_filter([{_PLAIN('x.valueMeaningName')} FOR x IN valueDomain.permissibleValues], lambda s: s <> ''), ';; '), '') AS names FROM items"))
def _(spark, d):
    x = fields.joined_objects(F.col("valueDomain.permissibleValues"), ["permissibleValue", "valueMeaningName"])
    return items(spark, d, "valueDomain").select("tinyId", x.alias("x")).select("tinyId", F.col("x.permissibleValue").alias("values_"), F.col("x.valueMeaningName").alias("names"))


@query("clean_in_place")
def _(spark, d):
    return st.clean_fields(items(spark, d, "designations", "definitions"), ["designations.*.designation", "definitions.*.definition"])[1]


@query("strip_diff")
def _(spark, d):
    t = st.strip_lists(texts(spark, d), {"phrase": pattern_lists(spark, d)["phrase"]}, {"stripped": ("phrase",)})
    return t.select("tinyId", "field_path", st.line_diff(F.col("text"), F.col("stripped")).alias("diff")).where("diff <> ''")


@query("lemma_codes", with_texts(r", tk AS (SELECT tinyId, field_path, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS surface, generate_subscripts(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 1) AS pos FROM texts), l AS (SELECT tinyId, field_path, pos, " + _LEMMA + " AS token FROM tk), c AS (SELECT token, count(*) AS n FROM l GROUP BY 1), rk AS (SELECT token, CASE WHEN n >= 2 AND row_number() OVER (ORDER BY n DESC, token) <= 10500 THEN row_number() OVER (ORDER BY n DESC, token) ELSE 0 END AS rank FROM c) SELECT tinyId, array_to_string(list(rank ORDER BY field_path, pos), ' ') AS codes FROM l JOIN rk USING (token) GROUP BY 1"))
def _(spark, d):
    t = en.lemmatised(texts(spark, d), dc.lemma)
    return en.encode(t, ag.vocabulary(t)).select("tinyId", F.array_join(F.transform("codes", lambda c: c.cast("string")), " ").alias("codes"))


@query("infix_slots")
def _(spark, d):
    forms = table(spark, d, "occurrences").where("phrase_id is not null and verbatim_text is not null").select("phrase_id", "verbatim_text").distinct()

    def one(key, pdf):
        import pandas as pd

        return pd.DataFrame([(key[0], *vb.infix(sorted(pdf["verbatim_text"])))], columns=["phrase_id", "begins", "slot", "ends"])

    return forms.groupBy("phrase_id").applyInPandas(one, "phrase_id string, begins string, slot string, ends string")


# ---- options of earlier operators


@query("concat_all_columns", "SELECT row_id, concat_ws(' | ', nullif(trim(pattern), ''), nullif(trim(tinyIds), ''), nullif(trim(type), ''), nullif(trim(source), '')) AS text FROM inst_full_patterns WHERE concat_ws('', trim(pattern), trim(tinyIds), trim(type), trim(source)) <> ''")
def _(spark, d):
    df = table(spark, d, "inst_full_patterns").select("row_id", "pattern", "tinyIds", "type", "source", "decision")
    return fields.concatenated(df, "row_id", without=["decision"], separator=" | ", skip_empty=True)


@query("pattern_file_exclude", with_texts(r"SELECT tinyId FROM texts GROUP BY tinyId HAVING NOT bool_or(regexp_matches(text, '(?i)as part of the \w+ battery|since the last visit|blood|heart'))"))
def _(spark, d):
    return filters.first_pattern(texts(spark, d), "tinyId", [("(broken", "bad"), ("as part of the \\w+ battery", "battery"), ("since the last visit", "visit"), ("blood|heart", "heart")], exclude=True)


@query("pattern_filters", "WITH p AS (SELECT text AS pattern, count(DISTINCT phrase_id) AS n_fields FROM phrases WHERE text IS NOT NULL GROUP BY 1), q AS (SELECT pattern FROM p WHERE len(list_filter(string_split_regex(pattern, '\\s+'), lambda w: w <> '')) >= 2 AND n_fields >= 1 AND lower(pattern) NOT IN (SELECT lower(pattern) FROM inst_full_patterns WHERE pattern IS NOT NULL)) SELECT pattern FROM q WHERE NOT EXISTS (SELECT 1 FROM q o WHERE length(o.pattern) > length(q.pattern) AND contains(lower(o.pattern), lower(q.pattern)))")
def _(spark, d):
    p = table(spark, d, "phrases").where("text is not null").groupBy(F.col("text").alias("pattern")).agg(F.countDistinct("phrase_id").alias("n_fields"))
    return filters.pattern_filters(p, table(spark, d, "inst_full_patterns").where("pattern is not null"), 2, 1, True).select("pattern")


@query("total_gain", "WITH o AS (SELECT phrase_id AS family, count(*) AS n_now, count(*) FILTER (loaded_at < TIMESTAMP '2024-06-01') AS n_before FROM occurrences WHERE phrase_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_families, count(*) FILTER (n_now > n_before) AS n_grown, CAST(sum(greatest(0, n_now - n_before)) AS BIGINT) AS total_gain FROM o")
def _(spark, d):
    o = table(spark, d, "occurrences").where("phrase_id is not null").withColumnRenamed("phrase_id", "family")
    now = o.groupBy("family").agg(F.count("*").alias("n"))
    return mt.total_gain(mt.marginal_gains(now, o.where("loaded_at < timestamp'2024-06-01'").groupBy("family").agg(F.count("*").alias("n"))))


def _responses(spark, d):
    from textlens.plans.q_curation import _responses as r

    return r(spark, d)


@query("vote_unanimous", CURATION["vote_majority"])
def _(spark, d):
    return cu.votes(_responses(spark, d), "unanimous")


@query("vote_every_phrase", f"WITH v AS ({CURATION['vote_majority']}), a AS (SELECT DISTINCT upper(acronym) AS phrase_id FROM instrument_match WHERE acronym IS NOT NULL) SELECT phrase_id, coalesce(category, 'instrument') AS category, coalesce(confidence, 0.0) AS confidence, coalesce(agreement, 'none') AS agreement FROM a LEFT JOIN v USING (phrase_id)")
def _(spark, d):
    r = _responses(spark, d)
    return cu.all_votes(r, r, ["instrument", "other", "review"])


_LONG = "text"
for _short, _whole in tx.CONTRACTIONS.items():
    _LONG = f"regexp_replace({_LONG}, '(?i){_short.replace(chr(39), chr(39) * 2)}\\b', '{_whole}', 'g')"


@query("expanded_contractions", with_texts(f"SELECT tinyId, field_path, {_LONG} AS text FROM texts"))
def _(spark, d):
    return texts(spark, d).select("tinyId", "field_path", tx.expand_contractions(F.col("text")).alias("text"))


@query("whole_words", with_texts(r"SELECT tinyId, field_path FROM texts WHERE regexp_matches(text, '(?:^|[^A-Za-z0-9_])battery(?:$|[^A-Za-z0-9_])')"))
def _(spark, d):
    return texts(spark, d).where(tx.contains_word(F.col("text"), F.lit("battery"))).select("tinyId", "field_path")


@query("lines_flattened", with_texts(f"SELECT tinyId, field_path, {_PLAIN('text')} AS text FROM texts"))
def _(spark, d):
    return texts(spark, d).select("tinyId", "field_path", tx.flatten_lines(F.trim("text")).alias("text"))
