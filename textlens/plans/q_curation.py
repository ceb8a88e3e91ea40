"""Queries: curation ledger, agreement, votes."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import curation as cu, packed
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _labels(spark, d):
    c = table(spark, d, "curation_decision").where("pattern_id is not null and curator is not null")
    rows = c.select(F.col("pattern_id").alias("item"), F.col("curator").alias("rater"), "decided_at", cu.decision(F.col("decision")).alias("label"))
    return cu.latest(rows, ["item", "rater"], "decided_at", "label")


_DEC = "n AS (SELECT pattern_id, pattern, curator, decided_at, modification, CASE lower(trim(decision)) WHEN 'keep' THEN 'strip' WHEN 'remove' THEN 'skip' WHEN '' THEN NULL ELSE lower(trim(decision)) END AS label FROM curation_decision WHERE pattern_id IS NOT NULL AND curator IS NOT NULL)"
_LAB = f"WITH {_DEC}, l AS (SELECT pattern_id AS item, curator AS rater, label FROM n WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pattern_id, curator ORDER BY decided_at DESC, label DESC) = 1)"
_CONS = _LAB + ", c AS (SELECT item, label, count(*) AS n FROM l GROUP BY 1, 2), k AS (SELECT item, label AS consensus, n, sum(n) OVER (PARTITION BY item) AS n_raters, row_number() OVER (PARTITION BY item ORDER BY n DESC, list_position(['strip', 'modify', 'skip', 'substitute'], label)) AS r FROM c), x AS (SELECT item, CAST(n_raters AS BIGINT) AS n_raters, consensus, CASE WHEN n_raters = 1 THEN 'single' WHEN n = n_raters THEN 'unanimous' WHEN n > n_raters / 2 THEN 'majority' ELSE 'split' END AS agreement FROM k WHERE r = 1)"


@query("consensus_vote", _CONS + " SELECT * FROM x")
def _(spark, d):
    return cu.consensus(_labels(spark, d))


@query("agreement_summary", _CONS + " SELECT count(*) AS n_reviewed, count(*) FILTER (agreement = 'unanimous') AS n_unanimous, count(*) FILTER (agreement = 'majority') AS n_majority, count(*) FILTER (agreement = 'split') AS n_split, round(count(*) FILTER (agreement = 'unanimous') / count(*) * 100, 4) AS overall_agreement_pct FROM x WHERE n_raters >= 2")
def _(spark, d):
    return cu.agreement_summary(_labels(spark, d))


@query("discrepancies", _CONS + " SELECT x.item, array_to_string(list_sort(list(rater || '=' || label)), '|') AS decisions, consensus, agreement FROM x JOIN l ON l.item = x.item WHERE agreement IN ('majority', 'split') GROUP BY x.item, consensus, agreement")
def _(spark, d):
    return cu.discrepancies(_labels(spark, d))


@query("cohens_kappa", _LAB + ", p AS (SELECT a.rater AS ra, b.rater AS rb, a.label AS p, b.label AS q FROM l a JOIN l b ON a.item = b.item AND a.rater < b.rater), s AS (SELECT ra, rb, count(*) AS n, count(*) FILTER (p = q) AS n_agree FROM p GROUP BY 1, 2), x AS (SELECT ra, rb, p AS c, count(*) AS x FROM p GROUP BY 1, 2, 3), y AS (SELECT ra, rb, q AS c, count(*) AS y FROM p GROUP BY 1, 2, 3), e AS (SELECT ra, rb, sum(x * y) AS cr FROM x JOIN y USING (ra, rb, c) GROUP BY 1, 2) SELECT ra AS rater_a, rb AS rater_b, n AS n_items, n_agree, round(n_agree / n, 4) AS observed, round(coalesce(cr, 0) / (n * n), 4) AS expected, round(CASE WHEN coalesce(cr, 0) / (n * n) >= 1 THEN 1.0 ELSE (n_agree / n - coalesce(cr, 0) / (n * n)) / (1 - coalesce(cr, 0) / (n * n)) END, 4) AS kappa FROM s LEFT JOIN e USING (ra, rb)")
def _(spark, d):
    return cu.cohens_kappa(_labels(spark, d))


@query("krippendorff_alpha", _LAB + ", il AS (SELECT item, label, count(*) AS n FROM l GROUP BY 1, 2), m AS (SELECT item, sum(n) AS m FROM il GROUP BY 1 HAVING sum(n) >= 2), j AS (SELECT * FROM il JOIN m USING (item)), t AS (SELECT sum(n) AS t, sum(n * (n - 1) / (m - 1)) AS o FROM j), e AS (SELECT sum(c * (c - 1)) AS e FROM (SELECT label, sum(n) AS c FROM j GROUP BY 1)) SELECT round(1 - (1 - o / t) / (1 - e / (t * (t - 1))), 4) AS alpha FROM t, e")
def _(spark, d):
    return cu.krippendorff_alpha(_labels(spark, d))


def _ledger(spark, d):
    c = table(spark, d, "curation_decision").where("pattern is not null and decided_at < timestamp'2024-09-01'").select("pattern", cu.decision(F.col("decision")).alias("decision"), "modification", "decided_at").where("decision is not null")
    best = c.groupBy("pattern").agg(F.max(F.struct("decided_at", "decision", F.coalesce("modification", F.lit("")).alias("modification"))).alias("m"))
    return best.select("pattern", "m.decision", F.nullif("m.modification", F.lit("")).alias("modification"))


_LED = f"{_DEC}, led AS (SELECT pattern, label AS decision, nullif(coalesce(modification, ''), '') AS modification FROM n WHERE pattern IS NOT NULL AND label IS NOT NULL AND decided_at < TIMESTAMP '2024-09-01' QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY decided_at DESC, label DESC, coalesce(modification, '') DESC) = 1)"


@query("ledger_classify", f"WITH {_LED}, cur AS (SELECT DISTINCT pattern FROM curation_decision WHERE pattern IS NOT NULL UNION SELECT DISTINCT pattern FROM substitute_patterns WHERE pattern IS NOT NULL), ids AS (SELECT DISTINCT pattern, curator AS tinyId FROM curation_decision WHERE pattern IS NOT NULL), lid AS (SELECT DISTINCT pattern, curator AS tinyId FROM curation_decision WHERE pattern IS NOT NULL AND loaded_at < TIMESTAMP '2024-09-01'), nw AS (SELECT DISTINCT pattern FROM (SELECT * FROM ids EXCEPT SELECT * FROM lid)) SELECT cur.pattern, CASE WHEN led.decision = 'strip' THEN 'auto_strip' WHEN led.decision IN ('skip', 'modify', 'substitute') AND nw.pattern IS NULL THEN 'auto_' || led.decision WHEN led.decision IN ('skip', 'modify', 'substitute') THEN 'review_changed_' || led.decision ELSE 'review_new' END AS status, led.decision AS prior, CASE WHEN led.decision IN ('modify', 'substitute') THEN led.modification END AS modification FROM cur LEFT JOIN led ON led.pattern = cur.pattern LEFT JOIN nw ON nw.pattern = cur.pattern")
def _(spark, d):
    # the ledger of one day meets all patterns; the curators stand for records seen before or new
    c = table(spark, d, "curation_decision").where("pattern is not null")
    current = c.select("pattern").unionByName(table(spark, d, "substitute_patterns").where("pattern is not null").select("pattern"))
    ids = c.select("pattern", F.col("curator").alias("tinyId")).distinct()
    return cu.classify(current, ids, _ledger(spark, d), c.where("loaded_at < timestamp'2024-09-01'").select("pattern", F.col("curator").alias("tinyId")))


@query("curation_gate", f"WITH {_LED}, cur AS (SELECT DISTINCT pattern FROM curation_decision WHERE pattern IS NOT NULL), ids AS (SELECT DISTINCT pattern, curator AS tinyId FROM curation_decision WHERE pattern IS NOT NULL), lid AS (SELECT DISTINCT pattern, curator AS tinyId FROM curation_decision WHERE pattern IS NOT NULL AND loaded_at < TIMESTAMP '2024-09-01'), nw AS (SELECT DISTINCT pattern FROM (SELECT * FROM ids EXCEPT SELECT * FROM lid)), c AS (SELECT cur.pattern, CASE WHEN led.decision = 'strip' THEN 'auto_strip' WHEN led.decision IN ('skip', 'modify', 'substitute') AND nw.pattern IS NULL THEN 'auto_' || led.decision WHEN led.decision IN ('skip', 'modify', 'substitute') THEN 'review_changed_' || led.decision ELSE 'review_new' END AS status, led.decision AS prior, CASE WHEN led.decision IN ('modify', 'substitute') THEN led.modification END AS modification FROM cur LEFT JOIN led ON led.pattern = cur.pattern LEFT JOIN nw ON nw.pattern = cur.pattern) SELECT CASE WHEN status LIKE 'auto_%' THEN 'resolved' ELSE 'review' END AS part, pattern, CASE WHEN status LIKE 'auto_%' THEN prior ELSE '' END AS decision FROM c")
def _(spark, d):
    c = table(spark, d, "curation_decision").where("pattern is not null")
    ids = c.select("pattern", F.col("curator").alias("tinyId")).distinct()
    auto, review = cu.gate(cu.classify(c.select("pattern"), ids, _ledger(spark, d), c.where("loaded_at < timestamp'2024-09-01'").select("pattern", F.col("curator").alias("tinyId"))))
    return auto.select(F.lit("resolved").alias("part"), "pattern", "decision").unionByName(review.select(F.lit("review").alias("part"), "pattern", "decision"))


@query("ledger_upsert", f"WITH {_DEC} SELECT pattern_id, label, decided_at FROM n WHERE label IS NOT NULL AND decided_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pattern_id ORDER BY decided_at DESC, label DESC) = 1")
def _(spark, d):
    c = table(spark, d, "curation_decision").select("pattern_id", "decided_at", cu.decision(F.col("decision")).alias("label")).where("label is not null and decided_at is not null and pattern_id is not null")
    early = c.where("decided_at < timestamp'2024-01-01'")
    return cu.upsert(early, c.where("decided_at >= timestamp'2024-01-01'"), ["pattern_id"], "decided_at").select("pattern_id", "label", "decided_at")


@query("finalise_decisions", f"WITH {_DEC} SELECT DISTINCT pattern, coalesce(label, 'strip') AS decision, CASE coalesce(label, 'strip') WHEN 'skip' THEN NULL WHEN 'modify' THEN coalesce(modification, pattern) ELSE pattern END AS final_pattern, CASE coalesce(label, 'strip') WHEN 'substitute' THEN coalesce(modification, '') WHEN 'skip' THEN NULL ELSE '' END AS replacement FROM n WHERE pattern IS NOT NULL")
def _(spark, d):
    return cu.finalise(table(spark, d, "curation_decision").where("pattern is not null and pattern_id is not null and curator is not null")).distinct()


def _responses(spark, d):
    c = table(spark, d, "instrument_match")
    return c.where("acronym is not null").select(F.upper("acronym").alias("phrase_id"), F.col("match_id").cast("string").alias("provider"), F.when(F.col("needs_review"), "review").when(F.col("char_start") % 2 == 0, "instrument").otherwise("other").alias("category"), F.coalesce("family_confidence", F.lit(0.0)).alias("confidence"), (F.col("char_end") % 3 + 1).cast("double").alias("weight")).distinct()


_RESP = "WITH r AS (SELECT DISTINCT upper(acronym) AS phrase_id, match_id, CASE WHEN needs_review THEN 'review' WHEN char_start % 2 = 0 THEN 'instrument' ELSE 'other' END AS category, coalesce(family_confidence, 0.0) AS confidence, CAST(char_end % 3 + 1 AS DOUBLE) AS weight FROM instrument_match WHERE acronym IS NOT NULL)"


def _vote_sql(w: str) -> str:
    return _RESP + f", p AS (SELECT phrase_id, category, sum({w}) AS w, count(*) AS n, avg(confidence) AS c FROM r WHERE confidence > 0 GROUP BY 1, 2), b AS (SELECT *, sum(n) OVER (PARTITION BY phrase_id) AS al FROM p QUALIFY row_number() OVER (PARTITION BY phrase_id ORDER BY w DESC, category) = 1) SELECT phrase_id, category, round(c, 4) AS confidence, CASE WHEN n = al THEN 'unanimous' WHEN n > al / 2 THEN 'majority' ELSE 'split' END AS agreement FROM b"


for _m, _w in (("majority", "1.0"), ("weighted", "weight"), ("confidence", "confidence")):

    @query(f"vote_{_m}", _vote_sql(_w))
    def _(spark, d, m=_m):
        return cu.votes(_responses(spark, d), m)


@query("vote_distributions", _vote_sql("1.0").replace("SELECT phrase_id, category, round", ", v AS (SELECT phrase_id, category, round").replace(" FROM b", " FROM b), x AS (SELECT 'category' AS what, category AS value FROM v UNION ALL SELECT 'agreement', agreement FROM v UNION ALL SELECT 'quintile', CAST(least(5, CAST(floor(confidence * 5) AS INT) + 1) AS VARCHAR) FROM v) SELECT what, value, count(*) AS n FROM x GROUP BY 1, 2"))
def _(spark, d):
    return cu.distributions(cu.votes(_responses(spark, d)))


@query("priority_split", "WITH w AS (SELECT unnest(regexp_extract_all(lower(verbatim_text), '[a-z]+')) AS word FROM occurrences), z AS (SELECT word, log10(count(*) / (SELECT count(*) FROM w) * 1e9) AS zipf FROM w GROUP BY 1), p AS (SELECT DISTINCT text AS pattern FROM phrases), s AS (SELECT pattern, min(coalesce(zipf, 0.0)) AS z FROM (SELECT DISTINCT pattern, unnest(regexp_extract_all(lower(pattern), '[a-z]+')) AS word FROM p) LEFT JOIN z USING (word) GROUP BY 1) SELECT p.pattern, CASE WHEN z >= 6.0 THEN 'low' ELSE 'high' END AS priority FROM p LEFT JOIN s USING (pattern)")
def _(spark, d):
    words = table(spark, d, "occurrences").select(F.explode(F.regexp_extract_all(F.lower("verbatim_text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total = words.agg(F.sum("n").alias("t"))
    zipf = words.crossJoin(F.broadcast(total)).select("word", F.log10(F.col("n") / F.col("t") * 1e9).alias("zipf"))
    return cu.priority_split(table(spark, d, "phrases").select(F.col("text").alias("pattern")), zipf, 6.0)


@query("packed_scope_ids", r"WITH i AS (SELECT row_id, unnest(list_filter(string_split_regex(regexp_replace(tinyIds, '[\[\](){}\"'']', '', 'g'), '[\s|,;]+'), lambda x: x <> '')) AS id FROM inst_full_patterns WHERE tinyIds IS NOT NULL) SELECT row_id, count(DISTINCT id) AS n_ids FROM i GROUP BY 1")
def _(spark, d):
    return packed.split_packed(table(spark, d, "inst_full_patterns"), "row_id", "tinyIds", None, words=True).groupBy("row_id").agg(F.countDistinct("item").alias("n_ids"))
