"""Queries: patterns against texts, stripping, clean-up, remnants."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import matching as mt, stripping as st
from textlens.plans.corpus import pattern_lists, texts, with_rules, with_texts
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
    return table(spark, d, "phrases").select(F.col("text").alias("pattern")).distinct()


_HITS = ", pats AS (SELECT DISTINCT text AS pattern FROM phrases), hits AS (SELECT p.pattern, t.tinyId, t.field, t.field_path, t.text FROM pats p JOIN texts t ON contains(lower(t.text), lower(p.pattern)))"
_DIST = _HITS + ", per AS (SELECT pattern, tinyId, max(CASE WHEN field = 'definition' THEN 1 ELSE 0 END) AS d, max(CASE WHEN field = 'designation' THEN 1 ELSE 0 END) AS g, max(CASE WHEN field NOT IN ('definition', 'designation') THEN 1 ELSE 0 END) AS o FROM hits GROUP BY 1, 2), dist AS (SELECT pattern, CAST(sum(d) AS BIGINT) AS n_definition, CAST(sum(g) AS BIGINT) AS n_designation, CAST(sum(o) AS BIGINT) AS n_other, count(*) AS n_ids, CAST(sum(d * g) AS BIGINT) AS n_both FROM per GROUP BY 1)"


@query("pattern_field_distribution", with_texts(_DIST + " SELECT * FROM dist"))
def _(spark, d):
    return mt.field_distribution(mt.literal_hits(texts(spark, d), _phrases(spark, d)))


@query("field_profile", with_texts(_DIST + " SELECT *, CASE WHEN n_definition > 0 AND n_designation = 0 THEN 'def-only' WHEN n_designation > 0 AND n_definition = 0 THEN 'desig-only' WHEN n_definition = n_both AND n_designation = n_both AND n_both > 0 THEN 'both-all' WHEN n_both + n_definition + n_designation > 0 THEN 'mixed' ELSE 'none' END AS profile FROM dist"))
def _(spark, d):
    return mt.field_profile(mt.field_distribution(mt.literal_hits(texts(spark, d), _phrases(spark, d))))


@query("match_summary", with_texts(_HITS + " SELECT pattern, count(*) AS n_matches, count(DISTINCT tinyId) AS n_ids FROM hits GROUP BY 1"))
def _(spark, d):
    return mt.literal_hits(texts(spark, d), _phrases(spark, d)).groupBy("pattern").agg(F.count("*").alias("n_matches"), F.countDistinct("tinyId").alias("n_ids"))


_SCOPE = ", sc AS (SELECT DISTINCT tinyId, trim(verbatim_text) AS pattern FROM occurrences WHERE tinyId IS NOT NULL AND verbatim_text IS NOT NULL AND trim(verbatim_text) <> '')"


def _scopes(spark, d):
    return table(spark, d, "occurrences").select("tinyId", F.trim("verbatim_text").alias("pattern")).where("tinyId is not null and pattern is not null and pattern <> ''").distinct()


@query("scoped_discovery", with_texts(_SCOPE + " SELECT sc.pattern, t.tinyId, t.field_path FROM texts t JOIN sc ON t.tinyId = sc.tinyId WHERE contains(lower(t.text), lower(sc.pattern))"))
def _(spark, d):
    return mt.scoped_hits(texts(spark, d), _scopes(spark, d)).select("pattern", "tinyId", "field_path")


@query("match_log", with_texts(_SCOPE + ", m AS (SELECT t.tinyId, t.field_path, sc.pattern, t.text, strpos(t.text, sc.pattern) AS a FROM texts t JOIN sc ON t.tinyId = sc.tinyId WHERE contains(t.text, sc.pattern)), b AS (SELECT *, greatest(1, a - 20) AS s, least(length(text), a + length(pattern) - 1 + 20) AS e FROM m) SELECT tinyId, field_path, pattern, (CASE WHEN s > 1 THEN '...' ELSE '' END) || substr(text, s, e - s + 1) || (CASE WHEN e < length(text) THEN '...' ELSE '' END) AS verbatim FROM b"))
def _(spark, d):
    return st.match_log(texts(spark, d), _scopes(spark, d))


@query("containment_conflicts", ", p AS (SELECT DISTINCT text, lower(text) AS l, length(text) AS ord FROM phrases)".replace(", p AS", "WITH p AS") + " SELECT a.text AS short, b.text AS long, CASE WHEN starts_with(b.l, a.l) THEN 'prefix' WHEN ends_with(b.l, a.l) THEN 'suffix' ELSE 'infix' END AS relation, a.ord < b.ord AS conflict FROM p a JOIN p b ON length(a.l) < length(b.l) AND contains(b.l, a.l)")
def _(spark, d):
    return mt.containment(_phrases(spark, d).withColumn("ord", F.length("pattern")))


@query("validate_subsumption", with_texts(_HITS + ", g AS (SELECT pattern, split_part(lower(pattern), ' ', 1) AS group_key FROM pats), own AS (SELECT DISTINCT g.group_key, h.pattern, h.tinyId, h.field_path FROM hits h JOIN g USING (pattern)), cov AS (SELECT DISTINCT a.group_key, a.pattern, a.tinyId, a.field_path FROM own a JOIN own b ON a.group_key = b.group_key AND a.tinyId = b.tinyId AND a.field_path = b.field_path WHERE length(b.pattern) > length(a.pattern) AND contains(lower(b.pattern), lower(a.pattern))), fr AS (SELECT group_key, pattern FROM (SELECT * FROM own EXCEPT SELECT * FROM cov) GROUP BY 1, 2) SELECT g.group_key, g.pattern, fr.pattern IS NOT NULL AS keep FROM g LEFT JOIN fr ON fr.group_key = g.group_key AND fr.pattern = g.pattern"))
def _(spark, d):
    groups = _phrases(spark, d).withColumn("group_key", F.get(F.split(F.lower("pattern"), " "), F.lit(0)))
    return mt.validate_subsumption(mt.literal_hits(texts(spark, d), _phrases(spark, d)), groups)


@query("remnant_context", with_texts(_HITS + r", s AS (SELECT pattern, lower(pattern) AS l, string_split(lower(text), lower(pattern)) AS p FROM hits), h AS (SELECT pattern, string_split_regex(list_reduce(p[1:i], lambda a, b: a || l || b), '\s+') AS l0, string_split_regex(list_reduce(p[i+1:len(p)], lambda a, b: a || l || b), '\s+') AS r0 FROM s, unnest(range(1, len(p))) q(i)), f AS (SELECT pattern, list_filter(l0, lambda w: w <> '') AS l, list_filter(r0, lambda w: w <> '') AS r FROM h), c AS (SELECT pattern, 'left' AS side, n AS n_words, array_to_string(l[len(l)-n+1:len(l)], ' ') AS words FROM f, unnest([1, 2, 3]) q(n) WHERE len(l) >= n UNION ALL SELECT pattern, 'right', n, array_to_string(r[1:n], ' ') FROM f, unnest([1, 2, 3]) q(n) WHERE len(r) >= n) SELECT pattern, side, n_words, words, count(*) AS n FROM c GROUP BY ALL"))
def _(spark, d):
    return mt.around(mt.literal_hits(texts(spark, d), _phrases(spark, d)))


@query("recall_metrics", "WITH w AS (SELECT DISTINCT coalesce(mode_, '?') AS label, pattern, tinyId FROM (SELECT substr(phrase_id, 1, 10) AS mode_, phrase_id AS pattern, tinyId FROM occurrences WHERE phrase_id IS NOT NULL AND tinyId IS NOT NULL)), c AS (SELECT DISTINCT tinyId FROM instrument_match WHERE tinyId IS NOT NULL), per AS (SELECT w.*, CASE WHEN c.tinyId IS NULL THEN 0 ELSE 1 END AS got FROM w LEFT JOIN c ON c.tinyId = w.tinyId), e AS (SELECT label, pattern, count(*) AS n_source, CAST(sum(got) AS BIGINT) AS n_captured FROM per GROUP BY 1, 2 UNION ALL SELECT label, NULL, count(*), CAST(sum(got) AS BIGINT) FROM (SELECT label, tinyId, max(got) AS got FROM per GROUP BY 1, 2) GROUP BY 1) SELECT *, n_source - n_captured AS n_missing, printf('%.3f', n_captured / n_source) AS recall FROM e")
def _(spark, d):
    wanted = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null").select(F.substring("phrase_id", 1, 10).alias("label"), F.col("phrase_id").alias("pattern"), "tinyId")
    captured = table(spark, d, "instrument_match").where("tinyId is not null").select("tinyId")
    return mt.recall(wanted, captured)


@query("marginal_gains", "WITH o AS (SELECT phrase_id AS family, count(*) AS n_now, count(*) FILTER (loaded_at < TIMESTAMP '2024-06-01') AS n_before FROM occurrences WHERE phrase_id IS NOT NULL GROUP BY 1) SELECT family, n_now, n_before, greatest(0, n_now - n_before) AS gain FROM o")
def _(spark, d):
    o = table(spark, d, "occurrences").where("phrase_id is not null").withColumnRenamed("phrase_id", "family")
    now = o.groupBy("family").agg(F.count("*").alias("n"))
    return mt.marginal_gains(now, o.where("loaded_at < timestamp'2024-06-01'").groupBy("family").agg(F.count("*").alias("n")))


@query("leakage_scan", with_texts(f", m AS (SELECT 'temporal' AS kind, tinyId, unnest(regexp_extract_all(lower(text), '({mt.TEMPORAL})')) AS match FROM texts UNION ALL SELECT 'boilerplate', tinyId, unnest(regexp_extract_all(lower(text), '({mt.BOILERPLATE})')) FROM texts) SELECT kind, match, count(*) AS n_hits, count(DISTINCT tinyId) AS n_ids FROM m GROUP BY 1, 2"))
def _(spark, d):
    return mt.leakage(texts(spark, d), {"temporal": mt.TEMPORAL, "boilerplate": mt.BOILERPLATE})


@query("anchor_residue", with_texts(r", m AS (SELECT tinyId, unnest(regexp_extract_all(lower(text), '(?:as part of|as a part of|based on|related to)\s+[^.;!?]{1,100}')) AS m FROM texts), c AS (SELECT tinyId, regexp_extract(m, '^(as part of|as a part of|based on|related to)', 1) AS anchor, trim(regexp_replace(regexp_replace(m, '^(as part of|as a part of|based on|related to)', ''), '\s+', ' ', 'g')) AS context FROM m) SELECT anchor, context, CASE WHEN regexp_matches(context, '^(the|a|an)$|^$') THEN 'empty' WHEN regexp_matches(context, '\b(battery|scale|index|inventory|questionnaire|survey|interview|checklist|schedule|form)\b') THEN 'instrument' ELSE 'other' END AS category, count(*) AS n, count(DISTINCT tinyId) AS n_ids FROM c GROUP BY ALL"))
def _(spark, d):
    return mt.anchor_residue(texts(spark, d))


@query("rare_words", with_texts(", w AS (SELECT tinyId, unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS w FROM texts), f AS (SELECT lower(w) AS l, w, count(*) AS c FROM w GROUP BY 1, 2), b AS (SELECT l, w AS word FROM f QUALIFY row_number() OVER (PARTITION BY l ORDER BY c DESC, w) = 1), n AS (SELECT lower(w) AS l, count(*) AS n, count(DISTINCT tinyId) AS n_ids FROM w GROUP BY 1), z AS (SELECT b.word, n.n, n.n_ids, round(log10(n.n / (SELECT count(*) FROM w) * 1e9) - CASE WHEN b.word = upper(b.word) THEN 2.5 ELSE 0 END, 4) AS zipf FROM b JOIN n USING (l)) SELECT * FROM z WHERE n_ids >= 3 AND zipf < 5.0"))
def _(spark, d):
    return mt.rare_words(texts(spark, d), most_zipf=5.0)


@query("residual_harvest", "WITH r AS (SELECT DISTINCT lemma AS phrase FROM verbatim_variants WHERE lemma IS NOT NULL), p AS (SELECT DISTINCT text AS pattern FROM phrases), m AS (SELECT phrase, pattern, CASE WHEN contains(lower(phrase), lower(pattern)) THEN 0 ELSE 1 END AS o FROM r JOIN p ON (contains(lower(phrase), lower(pattern)) OR contains(lower(pattern), lower(phrase))) AND len(list_intersect(regexp_extract_all(lower(phrase), '[a-z0-9]+'), regexp_extract_all(lower(pattern), '[a-z0-9]+'))) > 0), b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY o, pattern) = 1) SELECT r.phrase, CASE WHEN b.phrase IS NULL THEN 'new_candidate' WHEN o = 0 THEN 'should_have_matched' ELSE 'partial_match' END AS status, b.pattern FROM r LEFT JOIN b ON b.phrase = r.phrase")
def _(spark, d):
    return mt.harvest(table(spark, d, "verbatim_variants").where("lemma is not null").select(F.col("lemma").alias("phrase")), _phrases(spark, d))


@query("prefix_divergence", "WITH p AS (SELECT DISTINCT text AS pattern, string_split(lower(text), ' ') AS t FROM phrases), g AS (SELECT array_to_string(t[1:3], ' ') AS prefix, count(DISTINCT pattern) AS n_patterns, count(DISTINCT coalesce(t[4], '')) AS n_next FROM p WHERE len(t) >= 3 GROUP BY 1) SELECT *, round(n_next / n_patterns, 4) AS divergence FROM g WHERE n_patterns >= 2")
def _(spark, d):
    return mt.prefix_groups(_phrases(spark, d))


_RULES = [("in the past 7 days", ""), ("since the last visit", ""), ("during the last month", "recently"), ("at baseline", ""), ("As part of the", "Part of")]
_FOLD = "text"
for _p, _r in sorted(_RULES, key=lambda x: -len(x[0])):
    _FOLD = f"replace({_FOLD}, '{_p}', '{_r}')"


def _rules(spark, rules):
    return st.pattern_order(spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rules)], "file_ord int, phrase string, replace_with string"))


def _universal(spark, d):
    """Every rule of the substitution table, for all records."""
    s = table(spark, d, "substitute_patterns").where("pattern is not null and pattern <> '' and row_id is not null")
    return st.pattern_order(s.select(F.col("row_id").alias("file_ord"), F.col("pattern").alias("phrase"), F.coalesce("replace_with", F.lit("")).alias("replace_with")))


# a list as texts pattern, sign 1, replacement; folded over a text
_SUBSTITUTE = "u AS (SELECT list(pattern || chr(1) || coalesce(replace_with, '') ORDER BY -length(pattern), row_id) AS ps FROM substitute_patterns WHERE pattern IS NOT NULL AND pattern <> '' AND row_id IS NOT NULL)"
_REDUCE = lambda text, ps: f"list_reduce(list_prepend({text}, {ps}), lambda a, p: replace(a, split_part(p, chr(1), 1), split_part(p, chr(1), 2)))"


@query("strip_literal_ordered", with_texts(f", {_SUBSTITUTE} SELECT tinyId, field_path, {_REDUCE('text', 'u.ps')} AS stripped FROM texts, u"))
def _(spark, d):
    return st.strip(texts(spark, d), _universal(spark, d).select("ord", "phrase", "replace_with")).select("tinyId", "field_path", "stripped")


@query("strip_scoped", with_texts(_SCOPE + f", o AS (SELECT tinyId, list(pattern ORDER BY -length(pattern), pattern) AS ps FROM sc GROUP BY 1) SELECT t.tinyId, t.field_path, list_reduce(list_prepend({_FOLD}, coalesce(o.ps, [])), lambda a, p: replace(a, p, '')) AS stripped FROM texts t LEFT JOIN o ON o.tinyId = t.tinyId"))
def _(spark, d):
    rules = _rules(spark, _RULES).select(F.struct(F.col("ord.k0").alias("k0"), F.col("phrase").alias("k1")).alias("ord"), "phrase", "replace_with")
    own = _scopes(spark, d).select("tinyId", F.struct((-F.length("pattern")).alias("k0"), F.col("pattern").alias("k1")).alias("ord"), F.col("pattern").alias("phrase"), F.lit("").alias("replace_with"))
    return st.strip(texts(spark, d), rules, own).select("tinyId", "field_path", "stripped")


_TIME = r"\b(?:past|last|previous|since|baseline)\b"
_SPLIT_SUB = r"trim(string_split_regex(trim(regexp_replace(pattern, '\s*\(([A-Z][A-Z0-9\-]+)\)', '', 'g')), '\s+[-–]\s+|:\s+')[1])"


def _stage_lists(spark, d):
    """The pattern tables as universal lists of the four stages."""
    none = F.array().cast("array<string>")
    listed = lambda df, p, o: df.select(o.alias("file_ord"), p.alias("phrase"), F.lit("").alias("replace_with"), none.alias("ids")).where("phrase is not null and phrase <> ''").distinct()
    inst = table(spark, d, "inst_full_patterns").where("pattern is not null")
    sub = F.trim(F.get(F.split(F.trim(F.regexp_replace("pattern", r"\s*\(([A-Z][A-Z0-9\-]+)\)", "")), r"\s+[-–]\s+|:\s+"), F.lit(0)))
    text = table(spark, d, "phrases").where("text is not null and k >= 5")
    timed = F.col("text").rlike("(?i)" + _TIME)
    return {"inst_full": listed(inst, F.col("pattern"), F.col("pattern")), "inst_sub": listed(inst, sub, sub), "temporal": listed(text.where(timed), F.col("text"), F.col("text")), "phrase": listed(text.where(~timed), F.col("text"), F.col("text"))}


_LIST = lambda name, column, source: f"{name} AS (SELECT coalesce(list(p || chr(1) ORDER BY -length(p), p), []) AS ps FROM (SELECT DISTINCT {column} AS p FROM {source}) WHERE p IS NOT NULL AND p <> '')"
_LISTS = ", ".join([
    _LIST("lf", "pattern", "inst_full_patterns WHERE pattern IS NOT NULL"), _LIST("ls", _SPLIT_SUB, "inst_full_patterns WHERE pattern IS NOT NULL"),
    _LIST("lt", "text", f"phrases WHERE text IS NOT NULL AND k >= 5 AND regexp_matches(text, '(?i){_TIME}')"), _LIST("lp", "text", f"phrases WHERE text IS NOT NULL AND k >= 5 AND NOT regexp_matches(text, '(?i){_TIME}')"),
])
_TP = lambda x: _REDUCE(_REDUCE(x, "lt.ps"), "lp.ps")


@query("variants_7", with_texts(f", {_LISTS}, v AS (SELECT tinyId, field_path, text, {_REDUCE('text', 'lf.ps')} AS f, {_REDUCE('text', 'ls.ps')} AS s FROM texts, lf, ls), w AS (SELECT *, {_REDUCE('f', 'ls.ps')} AS b FROM v, ls) SELECT tinyId, field_path, f AS MTSFPF, s AS MFSTPF, b AS MTSTPF, {_TP('text')} AS MFSFPT, {_TP('f')} AS MTSFPT, {_TP('s')} AS MFSTPT, {_TP('b')} AS MTSTPT FROM w, lt, lp"))
def _(spark, d):
    return st.strip_lists(texts(spark, d), _stage_lists(spark, d), st.STAGES).select("tinyId", "field_path", *st.STAGES)


_RX = r"(?i)in the (?:past|previous) \d+ (?:days|hours)"


@query("strip_regex_modes", with_texts(rf", a AS (SELECT tinyId, field_path, text, regexp_replace(text, '{_RX}', '', 'g') AS t1 FROM texts), b AS (SELECT *, regexp_replace(t1, '(?i)\bat baseline\b', '', 'g') AS t2 FROM a), c AS (SELECT *, regexp_replace(t2, '(?i)\bas part of the\b', '', 'g') AS t3 FROM b) SELECT tinyId, field_path, trim(regexp_replace(regexp_replace(regexp_replace(t3, '\r\n?', chr(10), 'g'), '\n+', ' ', 'g'), ' {{2,}}', ' ', 'g'), ' ') AS stripped, concat_ws('|', CASE WHEN text <> t1 THEN 'REGEX:in the (?:past|previous) \d+ (?:days|hours)' END, CASE WHEN t1 <> t2 THEN 'at baseline' END, CASE WHEN t2 <> t3 THEN 'as part of the' END) AS matched FROM c"))
def _(spark, d):
    return st.strip_regex(texts(spark, d), [("REGEX:in the (?:past|previous) \\d+ (?:days|hours)", ""), ("at baseline", ""), ("as part of the", "")]).select("tinyId", "field_path", "stripped", F.array_join("matched", "|").alias("matched"))


def _listed(spark, d):
    lists = pattern_lists(spark, d)
    lists["substitute"] = with_rules(lists["substitute"], _RULES)
    return st.strip_lists(texts(spark, d), lists, {"stripped": ("substitute", "inst_full", "inst_sub", "phrase")})


@query("clean_text")
def _(spark, d):
    stripped = _listed(spark, d)
    return st.clean(stripped.select("tinyId", "field_path", "stripped"), "stripped")


@query("remnant_report")
def _(spark, d):
    stripped = _listed(spark, d)
    return st.remnants(stripped.select("tinyId", "field_path", F.col("stripped").alias("text")))


_RE2 = {k: v for k, v in st.REMNANTS.items() if "(?<" not in v}
_WORDS = r"string_split_regex(t, '\s')"
# RE2 has no look-behind: these two stand between white space, so they are told by the parts between it
_BEHIND = {
    "floating_punct": rf"len(list_filter({_WORDS}[2:len({_WORDS}) - 1], lambda w: regexp_full_match(w, '[,;:\-]{{1,3}}')))",
    "dangling_s": rf"len(list_filter({_WORDS}[2:], lambda w: regexp_matches(w, '^''?s(?:[^A-Za-z0-9_]|$)')))",
}
_COUNTS = {k: f"len(regexp_extract_all(t, '{v}'))" for k, v in _RE2.items()} | _BEHIND


@query("remnant_summary", with_texts(", s AS (SELECT tinyId, " + _FOLD + " AS t FROM texts), r AS (" + " UNION ALL ".join(f"SELECT '{k}' AS remnant_type, tinyId, {c} AS c FROM s" for k, c in _COUNTS.items()) + ") SELECT remnant_type, CAST(sum(c) AS BIGINT) AS n, count(DISTINCT tinyId) AS n_ids FROM r WHERE c > 0 GROUP BY 1"))
def _(spark, d):
    stripped = st.strip(texts(spark, d), _rules(spark, _RULES).select("ord", "phrase", "replace_with"))
    return st.remnant_summary(st.remnants(stripped.select("tinyId", "field_path", F.col("stripped").alias("text"))))


@query("strip_html")
def _(spark, d):
    return texts(spark, d).select("tinyId", "field_path", st.html_text(F.col("text")).alias("plain"), F.size(st.html_tables(F.col("text"))).alias("n_tables"))
