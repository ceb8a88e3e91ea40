"""Phrase mining: token windows, masked level-wise mining with occurrences, subsumption, phrase families.

Token sequences stay one row for each text; windows leave them as two 64-bit hashes (128 bits tell any
number of windows apart), and their text is looked up for those that qualify only. Counts combine map-side.
Occurrences are a table of their own and never collected into arrays across texts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlens.functions import text as tx
from textlens.session import discard, shared_dir, written


def sequences(texts: DataFrame, key: str = "tinyId") -> DataFrame:
    """(key, field_path, tokens, free): free tells which tokens no phrase owns yet."""
    t = tx.tokens(F.col("text"))
    return texts.select(key, "field_path", t.alias("tokens"), F.transform(t, lambda _: F.lit(True)).alias("free"))


def windows(k: int) -> Column:
    """Array of (pos, kmer) of the k-token windows with no masked token; empty if the text is shorter."""
    each = F.transform(F.sequence(F.lit(0), F.size("tokens") - k), lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("tokens", i + 1, k), " ").alias("kmer"), F.forall(F.slice("free", i + 1, k), lambda x: x).alias("open")))
    return F.when(F.size("tokens") >= k, F.filter(each, lambda w: w["open"]))


def count_kmers(seqs: DataFrame, k: int, least: int = 3, least_ids: int = 2, key: str = "tinyId") -> DataFrame:
    """(kmer, freq, n_ids): overlapping windows, both filters applied."""
    rows = seqs.select(key, F.explode(windows(k)).alias("w")).select(key, "w.kmer")
    per_id = rows.groupBy("kmer", key).agg(F.count("*").alias("n"))  # a second level keeps the distinct count combinable
    counts = per_id.groupBy("kmer").agg(F.sum("n").alias("freq"), F.count("*").alias("n_ids"))
    return counts.where((F.col("freq") >= least) & (F.col("n_ids") >= least_ids))


def mask(seqs: DataFrame, phrases: DataFrame, k: int, key: str = "tinyId") -> DataFrame:
    """seqs with the tokens of the phrases (column kmer, k tokens each) masked, left to right without overlap."""
    hits = seqs.select(key, "field_path", F.explode(windows(k)).alias("w")).select(key, "field_path", "w.pos", "w.kmer")
    hits = hits.join(phrases.select("kmer"), "kmer", "left_semi").groupBy(key, "field_path").agg(F.array_sort(F.collect_set("pos")).alias("starts"))
    taken = F.aggregate("starts", F.array().cast("array<int>"), lambda acc, s: F.when((F.size(acc) == 0) | (s >= F.try_element_at(acc, F.lit(-1)) + k), F.concat(acc, F.array(s))).otherwise(acc))
    own = seqs.join(hits, [key, "field_path"], "left").withColumn("starts", F.when(F.col("starts").isNotNull(), taken))
    free = F.transform("free", lambda f, i: f & ~F.exists("starts", lambda s: (i >= s) & (i < s + k)))
    return own.withColumn("free", F.when(F.col("starts").isNull(), F.col("free")).otherwise(free)).drop("starts")


@dataclass(frozen=True)
class Mined:
    """phrases (phrase_id, text, k, frequency, n_tinyids, extension_method) and
    occurrences (phrase_id, tinyId, field_path, token_start, token_end, verbatim_text)."""

    phrases: DataFrame
    occurrences: DataFrame


def _frequent(rows: DataFrame, by: list[str], least: int, least_ids: int) -> DataFrame:
    per_id = rows.groupBy(*by, "key").agg(F.count("*").alias("n"))
    return per_id.groupBy(*by).agg(F.sum("n").alias("freq"), F.count("*").alias("n_ids")).where((F.col("freq") >= least) & (F.col("n_ids") >= least_ids))


def mine_occurrences(texts: DataFrame, k_max: int = 25, k_min: int = 3, least: int = 3, least_ids: int = 2, key: str = "tinyId") -> Mined:
    """Frequent phrases from the longest windows to the shortest, each level masking what it found, with all their occurrences.

    texts: (key, field_path, text), or a ``sequences`` table whose ``free`` tokens only may be part of a phrase. A phrase's
    frequency counts all its open windows at its level, overlapping ones too; masked are those that do not overlap, from
    left to right. The long windows are found by their heads: a window of k tokens is open to counting only where all its
    windows of k_min tokens are frequent, so one count over (k, hash) finds all candidates, and the levels, which depend on
    each other, run over the candidates' few places and not over the texts.
    """
    ids = ["h1", "h2"]
    free = F.col("free") if "free" in texts.columns else F.lit(None).cast("array<boolean>")
    split = (F.col("tokens"), F.col("tokens")) if "tokens" in texts.columns else (tx.pieces(F.col("text")), tx.tokens(F.col("text")))
    rows = texts.select(F.col(key).alias("key"), "field_path", split[0].alias("pieces"), split[1].alias("tokens"), free.alias("free"))
    seqs = written(rows.where(F.size("tokens") >= k_min).withColumn("rid", F.monotonically_increasing_id()), "sequences")
    hashed = lambda at, k: [F.xxhash64(F.slice("tokens", at + 1, k)).alias("h1"), F.xxhash64(F.slice("tokens", at + 1, k), F.lit(7)).alias("h2")]
    starts = seqs.select("key", "rid", "tokens", "free", F.explode(F.sequence(F.lit(0), F.size("tokens") - k_min)).alias("pos"))
    starts = starts.where(F.col("free").isNull() | F.forall(F.slice("free", F.col("pos") + 1, k_min), lambda x: x)).select("key", "rid", "pos", *hashed(F.col("pos"), k_min))
    live = starts.join(_frequent(starts, ids, least, least_ids).select(*ids), ids, "left_semi").select("rid", "pos")
    found, low = [], k_min
    while True:
        # up to twice the length where all windows of length ``low`` are frequent, then again from there
        high = min(k_max, 2 * low + 1)
        island = F.col("pos") - F.row_number().over(Window.partitionBy("rid").orderBy("pos"))
        run = live.withColumn("island", island).withColumn("last", F.max("pos").over(Window.partitionBy("rid", "island")))
        reach = F.least(F.lit(high), F.col("last") - F.col("pos") + low)
        first = low if low == k_min else low + 1
        wide = run.where(reach >= first).select("rid", "pos", F.explode(F.sequence(F.lit(first), reach)).alias("k")).join(seqs.select("rid", "key", "tokens"), "rid").select("key", "rid", "pos", "k", *hashed(F.col("pos"), F.col("k")))
        wide = written(wide, "windows")
        some = written(wide.join(_frequent(wide, ["k", *ids], least, least_ids).select("k", *ids), ["k", *ids], "left_semi"), "candidates")
        discard(wide)
        found.append(some)
        if high == k_max:
            break
        live, low = some.where(F.col("k") == high).select("rid", "pos"), high
    path = found[0]
    for x in found[1:]:
        path = path.unionByName(x)
    levels = [r.k for r in path.select("k").distinct().orderBy(F.desc("k")).collect()]  # one row a length
    base = f"{shared_dir(seqs.sparkSession)}/levels-{uuid.uuid4().hex}"
    kind, kept = f"key {texts.schema[key].dataType.simpleString()}, rid bigint, pos int, h1 bigint, h2 bigint, freq bigint, n_ids bigint, own boolean, k int", []
    for k in levels:
        level = path.where(F.col("k") == k).drop("k")
        if kept:
            own = seqs.sparkSession.read.schema(kind).parquet(*kept).where("own").select("rid", F.col("pos").alias("begin"), (F.col("pos") + F.col("k")).alias("stop"))
            level = level.join(own, (level.rid == own.rid) & (level.pos < own.stop) & (level.pos + k > own.begin), "left_anti")
        hits = level.join(_frequent(level, ids, least, least_ids), ids)
        each = hits.groupBy("rid").agg(F.first("key").alias("key"), F.array_sort(F.collect_list(F.struct("pos", *ids, "freq", "n_ids"))).alias("w"))
        chosen = F.aggregate(F.transform("w", lambda x: x["pos"]), F.array().cast("array<int>"), lambda acc, s: F.when((F.size(acc) == 0) | (s >= F.try_element_at(acc, F.lit(-1)) + k), F.concat(acc, F.array(s))).otherwise(acc))
        out = each.withColumn("own", chosen).select("key", "rid", "own", F.explode("w").alias("w")).select("key", "rid", "w.*", F.array_contains("own", F.col("w.pos")).alias("own"))
        out.withColumn("k", F.lit(k)).write.parquet(f"{base}/{k:04}")
        kept.append(f"{base}/{k:04}")
    discard(*found)
    if not kept:
        spark = texts.sparkSession
        return Mined(spark.createDataFrame([], "phrase_id string, text string, k int, frequency bigint, n_tinyids bigint, extension_method string"), spark.createDataFrame([], f"phrase_id string, {key} string, field_path string, token_start int, token_end int, verbatim_text string"))
    every = seqs.sparkSession.read.schema(kind).parquet(*kept)
    told = every.select("rid", "pos", "k", "freq", "n_ids").join(seqs.select("rid", "key", "field_path", "tokens", "pieces"), "rid")
    text = F.array_join(F.slice("tokens", F.col("pos") + 1, F.col("k")), " ")
    as_written = tx.verbatim(F.col("pieces"), F.col("pos"), F.col("k")) if "tokens" not in texts.columns else text
    told = written(told.select("key", "field_path", "pos", "k", "freq", "n_ids", text.alias("text"), as_written.alias("verbatim_text")).withColumn("phrase_id", F.substring(F.md5("text"), 1, 16)), "mined")
    every._written_at = base
    discard(seqs, every)
    phrases = told.groupBy("phrase_id", "text", "k").agg(F.first("freq").alias("frequency"), F.first("n_ids").alias("n_tinyids")).withColumn("extension_method", F.lit("kmer"))
    return Mined(phrases, told.select("phrase_id", F.col("key").alias(key), "field_path", F.col("pos").alias("token_start"), (F.col("pos") + F.col("k")).alias("token_end"), "verbatim_text"))


def mine(texts: DataFrame, k_max: int = 25, k_min: int = 3, least: int = 3, least_ids: int = 2, key: str = "tinyId") -> DataFrame:
    """(phrase, k, freq, n_ids) of ``mine_occurrences``."""
    p = mine_occurrences(texts, k_max, k_min, least, least_ids, key).phrases
    return p.select(F.col("text").alias("phrase"), "k", F.col("frequency").alias("freq"), F.col("n_tinyids").alias("n_ids"))


def verbatim_variants(mined: Mined) -> DataFrame:
    """(lemma, variants, count): the spellings of each phrase joined by ``|`` in alphabetical order, and its occurrences."""
    forms = mined.occurrences.groupBy("phrase_id", F.trim(F.regexp_replace("verbatim_text", r"\s+", " ")).alias("form")).agg(F.count("*").alias("n"))
    per = forms.groupBy("phrase_id").agg(F.array_join(F.array_sort(F.collect_list("form")), "|").alias("variants"), F.sum("n").alias("count"))
    return mined.phrases.select("phrase_id", F.col("text").alias("lemma")).join(per, "phrase_id").select("lemma", "variants", "count")


def ngrams(texts: DataFrame, low: int, high: int) -> DataFrame:
    """(tinyId, field, phrase) of all n-grams, for the plain phrase collection."""
    seqs = texts.select("tinyId", "field", tx.tokens(F.col("text")).alias("tokens"))
    parts = []
    for n in range(low, high + 1):
        parts.append(seqs.where(F.size("tokens") >= n).select("tinyId", "field", F.explode(F.transform(F.sequence(F.lit(1), F.size("tokens") - n + 1), lambda i: F.array_join(F.slice("tokens", i, n), " "))).alias("phrase")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def phrase_ids(grams: DataFrame, least_ids: int = 2) -> DataFrame:
    """(field, phrase, n_ids)."""
    return grams.select("field", "phrase", "tinyId").distinct().groupBy("field", "phrase").agg(F.count("*").alias("n_ids")).where(F.col("n_ids") >= least_ids)


def sub_windows(phrases: DataFrame, text: str = "phrase") -> DataFrame:
    """(long, short): every proper contiguous token run of each phrase."""
    t = F.split(text, " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.transform(F.sequence(F.lit(1), F.size(t) - i + 1), lambda n: F.array_join(F.slice(t, i, n), " "))))
    return phrases.select(F.col(text).alias("long"), F.explode(F.array_distinct(runs)).alias("short")).where("long <> short")


def subsume(phrases: DataFrame, ids: DataFrame, coverage: float = 0.0, most_orphans: int | None = None) -> DataFrame:
    """Phrases that no kept longer phrase contains while sharing records.

    phrases: phrase. ids: (phrase, tinyId). A phrase is subsumed if a kept longer one contains it, they
    share a record, at least ``coverage`` of its records are shared, and at most ``most_orphans`` are not.
    Rounds go from the longest to the shortest: a phrase is decided once its containers are.
    """
    known = written(phrases.select("phrase", F.size(F.split("phrase", " ")).alias("k")).distinct(), "known")
    own = ids.groupBy("phrase").agg(F.countDistinct("tinyId").alias("n"))
    pairs = sub_windows(known).join(known.select(F.col("phrase").alias("short"), F.col("k").alias("k_short")), "short")
    a, b = ids.select(F.col("phrase").alias("long"), "tinyId").distinct(), ids.select(F.col("phrase").alias("short"), "tinyId").distinct()
    shared = pairs.join(a, "long").join(b, ["short", "tinyId"]).groupBy("long", "short", "k_short").agg(F.count("*").alias("both"))
    edges = shared.join(own.withColumnRenamed("phrase", "short"), "short").where(F.col("both") >= coverage * F.col("n"))
    if most_orphans is not None:
        edges = edges.where(F.col("n") - F.col("both") <= most_orphans)
    edges = written(edges.select("long", "short", "k_short"), "edges")
    gone = edges.select(F.col("short").alias("out")).where(F.lit(False))
    for k in [r.k_short for r in edges.select("k_short").distinct().orderBy(F.desc("k_short")).collect()]:  # one row for each length
        level = edges.where(F.col("k_short") == k).join(gone, F.col("long") == F.col("out"), "left_anti").select(F.col("short").alias("out")).distinct()
        gone = written(gone.unionByName(level), "gone")
    return known.join(gone, F.col("phrase") == F.col("out"), "left_anti").select("phrase", "k")


# ---- families of phrases (metadata: phrases, not texts)


def affix_families(phrases: DataFrame, side: str = "prefix", low: int = 3, high: int = 10, least: int = 3) -> DataFrame:
    """(affix, k, n_phrases, n_ids_max): prefixes (suffixes) of low..high tokens shared by ``least`` phrases or more."""
    t = F.split("text", " ")
    part = (lambda n: F.slice(t, 1, n)) if side == "prefix" else (lambda n: F.slice(t, -n, n))
    rows = phrases.where(F.size(t) >= low).select("phrase_id", "n_tinyids", F.explode(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.size(t))), lambda n: F.struct(n.alias("k"), F.array_join(part(n), " ").alias("affix")))).alias("a"))
    return rows.groupBy("a.affix", "a.k").agg(F.countDistinct("phrase_id").alias("n_phrases"), F.max(F.coalesce("n_tinyids", F.lit(0))).alias("n_ids_max")).where(F.col("n_phrases") >= least).select("affix", "k", "n_phrases", "n_ids_max")


def infix_index(phrases: DataFrame, low: int = 3, high: int = 10) -> DataFrame:
    """(infix, k, n_phrases, n_occurrences): member once for each phrase, occurrence each time."""
    t = F.split("text", " ")
    each = F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.size(t))), lambda n: F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.struct(n.alias("k"), F.array_join(F.slice(t, i, n), " ").alias("infix")))))
    rows = phrases.where(F.size(t) >= low).select("phrase_id", F.explode(each).alias("w"))
    return rows.groupBy("w.infix", "w.k").agg(F.countDistinct("phrase_id").alias("n_phrases"), F.count("*").alias("n_occurrences"))


def assign_families(phrases: DataFrame, families: DataFrame, how: str = "frequency") -> DataFrame:
    """(phrase_id, affix, confidence): family of each phrase among the prefixes it has; confidence is its share of members."""
    t = F.split("text", " ")
    rows = phrases.select("phrase_id", F.explode(F.transform(F.sequence(F.lit(1), F.size(t)), lambda n: F.array_join(F.slice(t, 1, n), " "))).alias("affix")).join(families.select("affix", "k", "n_phrases"), "affix")
    order = [F.desc("n_phrases"), F.desc("k")] if how == "frequency" else [F.desc("k"), F.desc("n_phrases")]
    w = Window.partitionBy("phrase_id")
    ranked = rows.withColumn("confidence", F.round(F.col("n_phrases") / F.sum("n_phrases").over(w), 4)).withColumn("r", F.row_number().over(w.orderBy(*order, "affix")))
    return ranked.where("r = 1 or " + ("true" if how == "all" else "false")).select("phrase_id", "affix", "confidence")


def branching(phrases: DataFrame, low: int = 2, high: int = 8) -> DataFrame:
    """(prefix, k, n_next, n_phrases): trie nodes with two continuations or more."""
    t = F.split("text", " ")
    rows = phrases.where(F.size(t) >= low).select("phrase_id", F.explode(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.size(t))), lambda n: F.struct(n.alias("k"), F.array_join(F.slice(t, 1, n), " ").alias("prefix"), F.coalesce(F.get(t, n), F.lit("")).alias("next")))).alias("w"))
    return rows.groupBy("w.prefix", "w.k").agg(F.countDistinct(F.nullif("w.next", F.lit(""))).alias("n_next"), F.countDistinct("phrase_id").alias("n_phrases")).where("n_next >= 2")


def connectors(phrases: DataFrame, least: int = 3) -> DataFrame:
    """(connector, n_extended): phrases that are a prefix or suffix of at least ``least`` longer phrases."""
    t = F.split("text", " ")
    ends = F.concat(F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda n: F.array_join(F.slice(t, 1, n), " ")), F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda n: F.array_join(F.slice(t, -n, n), " ")))
    rows = phrases.where(F.size(t) > 1).select(F.col("text").alias("longer"), F.explode(F.array_distinct(ends)).alias("connector")).distinct()
    return rows.join(phrases.select(F.col("text").alias("connector")).distinct(), "connector").groupBy("connector").agg(F.count("*").alias("n_extended")).where(F.col("n_extended") >= least)


def anchor_extensions(texts: DataFrame, phrases: DataFrame, k: int, least: int = 2) -> DataFrame:
    """(phrase, side, token, n): the neighbour token seen most beside each phrase of k tokens."""
    seqs = sequences(texts)
    hit = seqs.select("tokens", F.explode(windows(k)).alias("w")).join(phrases.select(F.col("kmer")), F.col("w.kmer") == F.col("kmer"))
    sides = F.array(F.struct(F.lit("left").alias("side"), F.when(F.col("w.pos") > 0, F.get("tokens", F.col("w.pos") - 1)).alias("token")), F.struct(F.lit("right").alias("side"), F.get("tokens", F.col("w.pos") + k).alias("token")))
    n = hit.select("kmer", F.explode(sides).alias("s")).where("s.token is not null").groupBy("kmer", "s.side", "s.token").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    best = n.groupBy("kmer", "side").agg(F.min(F.struct((-F.col("n")).alias("m"), "token")).alias("b"))
    return best.select(F.col("kmer").alias("phrase"), "side", "b.token", (-F.col("b.m")).alias("n"))
