"""Queries: groups, temporal frames, contigs, extensions, reports, workflow, streams' batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import grouping as gr, mining
from textlens.plans import workflow
from textlens.plans.corpus import items, pattern_lists, texts, with_items, with_rules, with_texts
from textlens.sources import files
from textlens.streaming import terms
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


_NAMES = r"r AS (SELECT DISTINCT text AS name FROM phrases WHERE text IS NOT NULL), tk AS (SELECT name, string_split(trim(regexp_replace(name, '\s+', ' ', 'g')), ' ') AS t FROM r), g AS (SELECT name, n AS k, lower(array_to_string(t[1:n], ' ')) AS p FROM tk, unnest(range(2, 60)) q(n) WHERE n <= len(t)), sh AS (SELECT p FROM g GROUP BY p HAVING count(*) >= 2), b AS (SELECT g.name, g.p FROM g JOIN sh USING (p) QUALIFY row_number() OVER (PARTITION BY g.name ORDER BY g.k DESC) = 1)"
_CUT = lambda x: f"regexp_replace({x}, '^[\\s\\-–—:;,./|]+|[\\s\\-–—:;,./|]+$', '', 'g')"


@query("name_prefix_groups", f"WITH {_NAMES} SELECT r.name, coalesce({_CUT(chr(34) + 'l' + chr(34))}, {_CUT('lower(r.name)')}) AS group_label FROM r LEFT JOIN (SELECT name, regexp_replace(p, '(?:[\\s\\-–:;,]+(?:{'|'.join(gr.FUNCTION_WORDS)}))+$', '') AS l FROM b) x ON x.name = r.name")
def _(spark, d):
    return gr.prefix_groups(table(spark, d, "phrases").select(F.col("text").alias("name")))


_LABELS = f"gl AS (SELECT r.name, coalesce({_CUT(chr(34) + 'l' + chr(34))}, {_CUT('lower(r.name)')}) AS group_label FROM r LEFT JOIN (SELECT name, regexp_replace(p, '(?:[\\s\\-–:;,]+(?:{'|'.join(gr.FUNCTION_WORDS)}))+$', '') AS l FROM b) x ON x.name = r.name)"


@query("group_hierarchy", f"WITH {_NAMES}, {_LABELS}, i AS (SELECT DISTINCT p.text AS name, o.tinyId FROM phrases p JOIN occurrences o USING (phrase_id) WHERE o.phrase_id IS NOT NULL AND o.tinyId IS NOT NULL AND p.text IS NOT NULL), z AS (SELECT group_label, count(DISTINCT tinyId) AS g FROM gl JOIN i USING (name) GROUP BY 1), k AS (SELECT group_label FROM z WHERE g >= 2 + floor(0.5 * sqrt((SELECT count(DISTINCT tinyId) FROM i)))), n AS (SELECT name, count(*) AS n_ids FROM i GROUP BY 1) SELECT group_label, gl.name, {_CUT('substr(gl.name, length(group_label) + 1)')} AS suffix, coalesce(n_ids, 0) AS n_ids FROM gl JOIN k USING (group_label) LEFT JOIN n ON n.name = gl.name")
def _(spark, d):
    p = table(spark, d, "phrases").select("phrase_id", F.col("text").alias("name"))
    occ = table(spark, d, "occurrences").where("phrase_id is not null").select("phrase_id", "tinyId")
    return gr.hierarchy(p.select("name"), p.join(occ, "phrase_id").select("name", "tinyId"), scale=0.5)


@query("adjacent_prefix", r"WITH r AS (SELECT DISTINCT text AS name FROM phrases WHERE text IS NOT NULL), t AS (SELECT name, string_split_regex(lower(name), '\s+') AS t, lag(string_split_regex(lower(name), '\s+')) OVER (ORDER BY name) AS b FROM r) SELECT name, CASE WHEN b IS NULL THEN 0 ELSE len(list_filter(range(1, least(len(t), len(b)) + 1), lambda n: t[1:n] = b[1:n])) END AS shared FROM t")
def _(spark, d):
    return gr.adjacent_prefix(table(spark, d, "phrases").select(F.col("text").alias("name")))


_TC = r"CASE WHEN regexp_matches(lower(text), '\b(?:in|over|during|within) the (?:past|last|previous)\b') THEN 'past' WHEN regexp_matches(lower(text), '\bsince\b') THEN 'since' WHEN regexp_matches(lower(text), '\bat (?:baseline|the time)\b') THEN 'at' WHEN regexp_matches(lower(text), '\b(?:during|within)\b') THEN 'during' ELSE 'none' END"


@query("temporal_classes", with_texts(f" SELECT {_TC} AS frame, count(*) AS n, count(DISTINCT tinyId) AS n_ids FROM texts GROUP BY 1"))
def _(spark, d):
    return texts(spark, d).groupBy(gr.temporal_class(F.col("text")).alias("frame")).agg(F.count("*").alias("n"), F.countDistinct("tinyId").alias("n_ids"))


@query("temporal_normalise", r"SELECT DISTINCT text AS phrase, regexp_replace(regexp_replace(lower(text), '\b(?:in|over|during|within) the (?:past|last|previous)\b', 'in the past', 'g'), '\bin the past (hour|day|week|month|year)\b', 'in the past 1 \1', 'g') AS normal FROM phrases WHERE text IS NOT NULL")
def _(spark, d):
    return table(spark, d, "phrases").where("text is not null").select(F.col("text").alias("phrase"), gr.temporal_normal(F.col("text")).alias("normal")).distinct()


@query("contig_extension")
def _(spark, d):
    return gr.contigs(mining.count_kmers(mining.sequences(texts(spark, d)), 4).select("kmer", "freq"))


@query("right_extension")
def _(spark, d):
    t = texts(spark, d)
    return gr.right_extension(t, mining.count_kmers(mining.sequences(t), 3, 10, 5).select("kmer"), least_ids=5)


@query("id_histogram", with_texts(", g AS (SELECT tinyId, array_to_string(t[i:i+2], ' ') AS kmer FROM (SELECT tinyId, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM texts), unnest(range(1, len(t) - 1)) r(i)), c AS (SELECT kmer, count(DISTINCT tinyId) AS n_ids FROM g GROUP BY 1 HAVING count(*) >= 3 AND count(DISTINCT tinyId) >= 2) SELECT 3 AS k, n_ids, count(*) AS n FROM c GROUP BY 2"))
def _(spark, d):
    return files.id_histogram(mining.count_kmers(mining.sequences(texts(spark, d)), 3).withColumn("k", F.lit(3)))


@query("path_phrases", "SELECT field_path AS path, phrase_id AS phrase, array_to_string(list_sort(list(DISTINCT tinyId)), ';') AS ids FROM occurrences WHERE phrase_id IS NOT NULL AND tinyId IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    o = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null")
    return files.path_phrases(o.select(F.col("field_path").alias("path"), F.col("phrase_id").alias("phrase"), "tinyId"))


@query("pipeline_metrics", with_items("SELECT 'items' AS what, count(*) AS n FROM items UNION ALL SELECT 'occurrences', count(*) FROM occurrences UNION ALL SELECT 'phrases', count(*) FROM phrases"))
def _(spark, d):
    rows = items(spark, d, "views").agg(F.lit("items").alias("what"), F.count("*").alias("n"))
    for name in ("occurrences", "phrases"):
        rows = rows.unionByName(table(spark, d, name).agg(F.lit(name).alias("what"), F.count("*").alias("n")))
    return rows


@query("production_strip")
def _(spark, d):
    lists = pattern_lists(spark, d)
    rules = {"substitute": [("at the time of sampling", "then")], "inst_full": [("As part of the", "")], "inst_sub": [(" battery,", ",")], "phrase": [("Indicator of whether", "")]}
    lists = {stage: with_rules(lists[stage], rules[stage]) for stage in lists}
    return workflow.production_strip(lists, gr.TEMPORAL_SEEDS).run(spark, {"texts": texts(spark, d).select("tinyId", "field_path", "text")})["tables"]["report"]


@query("daily_occurrences", "SELECT date_trunc('day', mined_at) AS window_start, field_path, count(*) AS n FROM occurrences WHERE mined_at IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    return terms.windowed_counts(table(spark, d, "occurrences").where("mined_at is not null"), "mined_at", ["field_path"])
