"""Curation: ledger classification and upsert, consensus by count, agreement statistics, votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textlens.session import written

OLD_WORDS = {"keep": "strip", "remove": "skip"}
TIE_ORDER = ("strip", "modify", "skip", "substitute")


def decision(c):
    """Trimmed lower-case decision with old words mapped; null if blank."""
    d = F.nullif(F.lower(F.trim(c)), F.lit(""))
    for old, new in OLD_WORDS.items():
        d = F.when(d == old, new).otherwise(d)
    return d


def latest(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """The latest non-null value of each key (ties: the greater value); combines map-side."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(F.struct(at, value)).alias("m")).select(*keys, F.col(f"m.{value}").alias(value))


def classify(current: DataFrame, ids: DataFrame, ledger: DataFrame, ledger_ids: DataFrame) -> DataFrame:
    """(pattern, status, prior, modification): current patterns against the ledger.

    strip resolves itself; skip, modify and substitute do unless the pattern has records the ledger has
    not seen; unknown patterns and decisions need review. ids, ledger_ids: (pattern, tinyId).
    """
    new = ids.select("pattern", "tinyId").join(ledger_ids.select("pattern", "tinyId").distinct(), ["pattern", "tinyId"], "left_anti").select("pattern").distinct().withColumn("has_new", F.lit(True))
    j = current.select("pattern").distinct().join(ledger.select("pattern", F.col("decision").alias("prior"), "modification"), "pattern", "left").join(new, "pattern", "left")
    has_new = F.coalesce("has_new", F.lit(False))
    known = F.col("prior").isin("skip", "modify", "substitute")
    status = F.when(F.col("prior") == "strip", "auto_strip").when(known & ~has_new, F.concat(F.lit("auto_"), "prior")).when(known, F.concat(F.lit("review_changed_"), "prior")).otherwise("review_new")
    return j.select("pattern", status.alias("status"), "prior", F.when(F.col("prior").isin("modify", "substitute"), F.col("modification")).alias("modification"))


def upsert(ledger: DataFrame, decided: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Ledger with the later row of each key; both with equal columns."""
    rows = ledger.unionByName(decided)
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct(at, *[c for c in rest if c != at])).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(c) for c in rest])


def finalise(reviewed: DataFrame) -> DataFrame:
    """(pattern, decision, final_pattern, replacement): a blank decision strips, modify renames, substitute replaces."""
    d = F.coalesce(decision(F.col("decision")), F.lit("strip"))
    return reviewed.select("pattern", d.alias("decision"), F.when(d == "skip", None).when(d == "modify", F.coalesce("modification", "pattern")).otherwise(F.col("pattern")).alias("final_pattern"), F.when(d == "substitute", F.coalesce("modification", F.lit(""))).when(d != "skip", "").alias("replacement"))


def gate(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, needs review) of ``classify`` rows; review rows have empty decision and notes to fill in."""
    auto = F.startswith("status", F.lit("auto_"))
    note = F.when(F.startswith("status", F.lit("review_changed_")), F.concat(F.lit("previously "), "prior", F.lit("; new records")))
    review = classified.where(~auto).select("pattern", F.lit("").alias("decision"), "modification", F.coalesce(note, F.lit("")).alias("notes"))
    return classified.where(auto).select("pattern", F.col("prior").alias("decision"), "modification", F.concat(F.lit("ledger_"), "status").alias("source")), review


def sheets(patterns: DataFrame, curators: list[str]) -> DataFrame:
    """(curator, pattern, decision, modification): an empty sheet of every pattern for each curator, to be written by curator."""
    each = F.explode(F.array(*[F.lit(c) for c in curators]))
    return patterns.select(each.alias("curator"), "pattern", F.lit("").alias("decision"), F.lit("").alias("modification"))


def merge_sheets(filled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(consensus rows, discrepancies) of filled sheets (curator, pattern, decision)."""
    labels = filled.select(F.col("pattern").alias("item"), F.col("curator").alias("rater"), decision(F.col("decision")).alias("label")).where("label is not null").groupBy("item", "rater").agg(F.max("label").alias("label"))
    return consensus(labels), discrepancies(labels)


def consensus(labels: DataFrame) -> DataFrame:
    """(item, n_raters, consensus, agreement): unanimous, majority or split; ties by a fixed order.

    labels: (item, rater, label), one for each item and rater.
    """
    counts = labels.groupBy("item", "label").agg(F.count("*").alias("n"))
    rank = F.coalesce(F.element_at(F.create_map(*[x for i, c in enumerate(TIE_ORDER) for x in (F.lit(c), F.lit(i))]), F.col("label")), F.lit(99))
    best = counts.groupBy("item").agg(F.sum("n").alias("n_raters"), F.min(F.struct((-F.col("n")).alias("m"), rank.alias("r"), "label")).alias("b"))
    top = -F.col("b.m")
    level = F.when(F.col("n_raters") == 1, "single").when(top == F.col("n_raters"), "unanimous").when(top > F.col("n_raters") / 2, "majority").otherwise("split")
    return best.select("item", "n_raters", F.col("b.label").alias("consensus"), level.alias("agreement"))


def agreement_summary(labels: DataFrame) -> DataFrame:
    """One row: n_reviewed (two raters or more), n_unanimous, n_majority, n_split, overall_agreement_pct."""
    c = consensus(labels).where("n_raters >= 2")
    n = lambda a: F.count(F.when(F.col("agreement") == a, 1))
    return c.agg(F.count("*").alias("n_reviewed"), n("unanimous").alias("n_unanimous"), n("majority").alias("n_majority"), n("split").alias("n_split"), F.round(n("unanimous") / F.count("*") * 100, 4).alias("overall_agreement_pct"))


def cohens_kappa(labels: DataFrame) -> DataFrame:
    """(rater_a, rater_b, n_items, n_agree, observed, expected, kappa) of each pair of raters.

    Pairs are made within an item's labels (one a rater), then only the confusion counts are combined.
    """
    per_item = labels.groupBy("item").agg(F.array_sort(F.collect_set(F.struct("rater", "label"))).alias("l"))
    pairs = per_item.select(F.explode(F.flatten(F.transform("l", lambda x, i: F.transform(F.filter("l", lambda y: y["rater"] > x["rater"]), lambda y: F.struct(x["rater"].alias("a"), y["rater"].alias("b"), x["label"].alias("p"), y["label"].alias("q"))))))).select("col.*")
    cells = pairs.groupBy("a", "b", "p", "q").agg(F.count("*").alias("n"))
    sums = cells.groupBy("a", "b").agg(F.sum("n").alias("n_items"), F.sum(F.when(F.col("p") == F.col("q"), F.col("n")).otherwise(0)).alias("n_agree"))
    left, right = cells.groupBy("a", "b", F.col("p").alias("c")).agg(F.sum("n").alias("x")), cells.groupBy("a", "b", F.col("q").alias("c")).agg(F.sum("n").alias("y"))
    cross = left.join(right, ["a", "b", "c"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("cross"))
    po, pe = F.col("n_agree") / F.col("n_items"), F.coalesce("cross", F.lit(0)) / (F.col("n_items") * F.col("n_items"))
    return sums.join(cross, ["a", "b"], "left").select(F.col("a").alias("rater_a"), F.col("b").alias("rater_b"), "n_items", "n_agree", F.round(po, 4).alias("observed"), F.round(pe, 4).alias("expected"), F.round(F.when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe)), 4).alias("kappa"))


def krippendorff_alpha(labels: DataFrame) -> DataFrame:
    """One row alpha (nominal, missing labels allowed); null with fewer than two items that two raters saw.

    From the coincidence matrix in closed form: only counts by item and label, then by label.
    """
    n = labels.groupBy("item", "label").agg(F.count("*").alias("n"))
    items = n.groupBy("item").agg(F.sum("n").alias("m")).where("m >= 2")
    j = n.join(items, "item")
    agree = j.agg(F.sum(F.col("n") * (F.col("n") - 1) / (F.col("m") - 1)).alias("o"), F.sum("n").alias("t"), F.countDistinct("item").alias("items"))
    chance = j.groupBy("label").agg(F.sum("n").alias("c")).agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("e"))
    t = F.col("t")
    do, de = 1 - F.col("o") / t, 1 - F.col("e") / (t * (t - 1))
    return agree.crossJoin(chance).select(F.when(F.col("items") >= 2, F.round(F.when(de == 0, 1.0).otherwise(1 - do / de), 4)).alias("alpha"))


def votes(responses: DataFrame, method: str = "majority") -> DataFrame:
    """(phrase_id, category, confidence, agreement) from (phrase_id, provider, category, confidence, weight).

    Methods majority, weighted (by weight), confidence (by confidence) or unanimous (else majority).
    Responses of no confidence are errors and do not vote; a phrase without votes has no row here.
    """
    weight = {"majority": F.lit(1.0), "unanimous": F.lit(1.0), "weighted": F.col("weight"), "confidence": F.col("confidence")}[method]
    valid = responses.where("confidence > 0")
    per = valid.groupBy("phrase_id", "category").agg(F.sum(weight).alias("w"), F.count("*").alias("n"), F.avg("confidence").alias("c"))
    best = per.groupBy("phrase_id").agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("w")).alias("m"), "category", "n", "c")).alias("b"))
    level = F.when(F.col("b.n") == F.col("all"), "unanimous").when(F.col("b.n") > F.col("all") / 2, "majority").otherwise("split")
    return best.select("phrase_id", "b.category", F.round("b.c", 4).alias("confidence"), level.alias("agreement"))


def all_votes(responses: DataFrame, phrases: DataFrame, categories: list[str], method: str = "majority") -> DataFrame:
    """``votes`` of every phrase (phrase_id); one without a valid vote has the first category, confidence 0 and agreement ``none``."""
    v = phrases.select("phrase_id").distinct().join(votes(responses, method), "phrase_id", "left")
    return v.select("phrase_id", F.coalesce("category", F.lit(categories[0])).alias("category"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("agreement", F.lit("none")).alias("agreement"))


def distributions(voted: DataFrame) -> DataFrame:
    """(what, value, n): counts by category, agreement and confidence quintile."""
    quintile = F.least(F.lit(5), F.floor(F.col("confidence") * 5).cast("int") + 1).cast("string")
    parts = [voted.select(F.lit(w).alias("what"), c.alias("value")) for w, c in (("category", F.col("category")), ("agreement", F.col("agreement")), ("quintile", quintile))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("what", "value").agg(F.count("*").alias("n"))


def discrepancies(labels: DataFrame) -> DataFrame:
    """(item, decisions, consensus, agreement) of the items raters disagree on; decisions as rater=label, sorted."""
    c = consensus(labels).where("agreement in ('majority', 'split')")
    d = labels.groupBy("item").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "rater", "label"))), "|").alias("decisions"))
    return c.join(d, "item").select("item", "decisions", "consensus", "agreement")


def priority_split(patterns: DataFrame, zipf: DataFrame, least: float = 4.0) -> DataFrame:
    """(pattern, priority): low if every word of the pattern is common (Zipf score of ``least`` or more)."""
    words = patterns.select("pattern", F.explode(F.regexp_extract_all(F.lower("pattern"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    score = words.join(zipf.select("word", "zipf"), "word", "left").groupBy("pattern").agg(F.min(F.coalesce("zipf", F.lit(0.0))).alias("z"))
    return patterns.select("pattern").distinct().join(score, "pattern", "left").select("pattern", F.when(F.col("z") >= least, "low").otherwise("high").alias("priority"))


def dense_order(df: DataFrame, by: list) -> DataFrame:
    """df with ``rank`` from 1 in one total order (``by`` should end with a key, so that no rows tie).

    Rows are range-partitioned and written; each partition numbers its own rows and adds what lies before it. Only one
    count a partition comes together.
    """
    rows = written(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ordered")
    counts = rows.groupBy("_part").agg(F.count("*").alias("n"))  # one row a partition
    before = counts.withColumn("_before", F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return rows.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn("rank", F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")
