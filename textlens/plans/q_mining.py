"""Queries: phrase mining and phrase families."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.operators import mining
from textlens.plans.corpus import texts, with_texts
from textlens.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


_TOK = ", s AS (SELECT tinyId, field, field_path, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM texts)"


def _grams(k: int) -> str:
    return f"{_TOK}, g AS (SELECT tinyId, field, field_path, i - 1 AS pos, array_to_string(t[i:i+{k - 1}], ' ') AS kmer FROM s, unnest(range(1, len(t) - {k - 2})) r(i) WHERE len(t) >= {k})"


for _k in (3, 5, 8):

    @query(f"kmer_counts_k{_k}", with_texts(_grams(_k) + " SELECT kmer, count(*) AS freq, count(DISTINCT tinyId) AS n_ids FROM g GROUP BY kmer HAVING count(*) >= 3 AND count(DISTINCT tinyId) >= 2"))
    def _(spark, d, k=_k):
        return mining.count_kmers(mining.sequences(texts(spark, d)), k)


@query("mine_phrases")
def _(spark, d):
    return mining.mine(texts(spark, d))


@query("masked_kmers")
def _(spark, d):
    seqs = mining.sequences(texts(spark, d))
    masked = mining.mask(seqs, mining.count_kmers(seqs, 6), 6)
    return mining.count_kmers(masked, 3)


@query("subsume_phrases")
def _(spark, d):
    occ = table(spark, d, "occurrences").where("phrase_id is not null and tinyId is not null")
    phrases = table(spark, d, "phrases").select("phrase_id", F.col("text").alias("phrase"))
    return mining.subsume(phrases, occ.join(phrases, "phrase_id").select("phrase", "tinyId").distinct(), 0.5, 10)


@query("ngram_phrases", with_texts(_TOK + ", g AS (SELECT tinyId, field, array_to_string(t[i:i+n-1], ' ') AS phrase FROM s, unnest(range(1, len(t) + 1)) r(i), unnest([4, 5]) q(n) WHERE i + n - 1 <= len(t)) SELECT field, phrase, count(DISTINCT tinyId) AS n_ids FROM g GROUP BY 1, 2 HAVING count(DISTINCT tinyId) >= 2"))
def _(spark, d):
    return mining.phrase_ids(mining.ngrams(texts(spark, d), 4, 5))


_P = "p AS (SELECT phrase_id, text, n_tinyids, string_split(text, ' ') AS t FROM phrases)"
_PRE = "SELECT array_to_string(t[1:n], ' ') AS affix, n AS k, count(DISTINCT phrase_id) AS n_phrases, max(coalesce(n_tinyids, 0)) AS n_ids_max FROM p, unnest(range(3, 11)) r(n) WHERE n <= len(t) GROUP BY 1, 2 HAVING count(DISTINCT phrase_id) >= 3"


@query("prefix_families", f"WITH {_P} {_PRE}")
def _(spark, d):
    return mining.affix_families(table(spark, d, "phrases"))


@query("suffix_families", f"WITH {_P} {_PRE.replace('t[1:n]', 't[len(t)-n+1:len(t)]')}")
def _(spark, d):
    return mining.affix_families(table(spark, d, "phrases"), "suffix")


@query("infix_index", f"WITH {_P} SELECT array_to_string(t[i:i+n-1], ' ') AS infix, n AS k, count(DISTINCT phrase_id) AS n_phrases, count(*) AS n_occurrences FROM p, unnest(range(3, 11)) r(n), unnest(range(1, 100)) q(i) WHERE i + n - 1 <= len(t) GROUP BY 1, 2")
def _(spark, d):
    return mining.infix_index(table(spark, d, "phrases"))


@query("family_assign", f"WITH {_P}, f AS ({_PRE}), m AS (SELECT p.phrase_id, f.affix, f.k, f.n_phrases FROM p JOIN f ON len(p.t) >= f.k AND array_to_string(p.t[1:f.k], ' ') = f.affix) SELECT phrase_id, affix, round(n_phrases / sum(n_phrases) OVER (PARTITION BY phrase_id), 4) AS confidence FROM m QUALIFY row_number() OVER (PARTITION BY phrase_id ORDER BY n_phrases DESC, k DESC, affix) = 1")
def _(spark, d):
    p = table(spark, d, "phrases")
    return mining.assign_families(p, mining.affix_families(p))


@query("trie_branching", f"WITH {_P} SELECT array_to_string(t[1:n], ' ') AS prefix, n AS k, count(DISTINCT t[n+1]) AS n_next, count(DISTINCT phrase_id) AS n_phrases FROM p, unnest(range(2, 9)) r(n) WHERE n <= len(t) GROUP BY 1, 2 HAVING count(DISTINCT t[n+1]) >= 2")
def _(spark, d):
    return mining.branching(table(spark, d, "phrases"))


@query("connector_groups", f"WITH {_P}, e AS (SELECT DISTINCT text AS longer, unnest([array_to_string(t[1:n], ' '), array_to_string(t[len(t)-n+1:len(t)], ' ')]) AS connector FROM p, unnest(range(1, 40)) r(n) WHERE n < len(t)) SELECT connector, count(*) AS n_extended FROM e WHERE connector IN (SELECT text FROM phrases) GROUP BY 1 HAVING count(*) >= 3")
def _(spark, d):
    return mining.connectors(table(spark, d, "phrases").dropDuplicates(["text"]))


@query("anchor_extension", with_texts(_grams(4) + ", c AS (SELECT kmer FROM g GROUP BY kmer HAVING count(*) >= 3 AND count(DISTINCT tinyId) >= 2), n AS (SELECT g.kmer, unnest(['left', 'right']) AS side, unnest([CASE WHEN pos > 0 THEN s.t[pos] END, s.t[pos + 5]]) AS token FROM g JOIN c USING (kmer) JOIN s ON s.tinyId = g.tinyId AND s.field_path = g.field_path), m AS (SELECT kmer, side, token, count(*) AS n FROM n WHERE token IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2) SELECT kmer AS phrase, side, token, n FROM m QUALIFY row_number() OVER (PARTITION BY kmer, side ORDER BY n DESC, token) = 1"))
def _(spark, d):
    t = texts(spark, d)
    return mining.anchor_extensions(t, mining.count_kmers(mining.sequences(t), 4), 4)
