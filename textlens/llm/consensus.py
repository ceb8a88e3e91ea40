"""Consensus of annotators who disagree, by a community confusion model (problem 3).

Every annotator belongs to a latent type; each type has one confusion matrix (row: true class, column:
label given) that its annotators share, so an annotator with few labels is judged as one of the type.
Classes, types and matrices have Dirichlet priors. Inference is mean-field and variational: in turn the
items' class distributions, then the annotators' types, the matrices, the class and type weights each take
the distribution that is best given the others. No step lowers the evidence bound, which is computed in each
pass; passes go on until it gains less than ``LEAST_GAIN`` an item.

The items' update is one pass over the items in numpy batches; it returns the expected confusion counts
of each annotator (annotators x classes x classes), the only thing the driver sees. These grow with the
annotators, not with items or labels. With more than ``MAX_ANNOTATORS`` the model refuses; split the
annotators by the items they share.

Labels: blank and null labels do not count, stray case and blanks are cleaned, old words are mapped, other
words are ignored. The latest label of an annotator for an item counts (ties: the greater label). Items
with fewer than ``least`` annotators have no consensus but still teach. Ties between classes go to the
first class. Rows with null item or annotator do not count. Empty input gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.session import table, written

MAX_ANNOTATORS, LEAST_GAIN, TYPES = 100_000, 1e-5, 8
CLASSES = ("strip", "skip", "modify", "substitute")
OLD_WORDS = {"keep": "strip", "remove": "skip"}


def latest_labels(df: DataFrame, item: str, annotator: str, label: str, at: str, classes=CLASSES, old: dict | None = None) -> DataFrame:
    """(item, annotator, label): the latest usable label of each annotator for each item."""
    clean = F.lower(F.trim(F.regexp_replace(F.col(label), r"(?U)^\s+|\s+$", "")))
    for was, now in (OLD_WORDS if old is None else old).items():
        clean = F.when(clean == was, now).otherwise(clean)
    rows = df.select(F.col(item).alias("item"), F.col(annotator).alias("annotator"), clean.alias("label"), F.col(at).alias("at"))
    rows = rows.where(F.col("label").isin(*classes) & F.col("item").isNotNull() & F.col("annotator").isNotNull())
    return rows.groupBy("item", "annotator").agg(F.max(F.struct("at", "label")).alias("m")).select("item", "annotator", "m.label")


def _digamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(6):
        low = x < 6
        shift = shift - np.where(low, 1 / x, 0)
        x = np.where(low, x + 1, x)
    i2 = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - i2 * (1 / 12 - i2 * (1 / 120 - i2 / 252))


def _mean_log(a: np.ndarray) -> np.ndarray:
    return _digamma(a) - _digamma(a.sum(-1, keepdims=True))


def posteriors(annotators: np.ndarray, labels: np.ndarray, start: np.ndarray, log_class: np.ndarray, log_conf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class distribution of each item and the log of its weight; start: first label of each item in the flat arrays."""
    score = np.add.reduceat(log_conf[annotators, :, labels], start, axis=0) + log_class
    most = score.max(1, keepdims=True)
    q = np.exp(score - most)
    total = q.sum(1, keepdims=True)
    return q / total, (most + np.log(total))[:, 0]


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _divergence(a: np.ndarray, prior: np.ndarray) -> float:
    """KL from Dirichlet(prior) to Dirichlet(a), summed over all but the last axis."""
    prior = np.broadcast_to(prior, a.shape)
    norm = lambda x: _lgamma(x.sum(-1)) - _lgamma(x).sum(-1)
    return float((norm(a) - norm(prior) + ((a - prior) * _mean_log(a)).sum(-1)).sum())


def _flat(pdf: pd.DataFrame):
    n = pdf["a"].map(len).to_numpy()
    return np.concatenate(pdf["a"].to_numpy()).astype(int), np.concatenate(pdf["v"].to_numpy()).astype(int), np.concatenate([[0], np.cumsum(n)[:-1]]), n


class Model:
    """Variational state on the driver: Dirichlets of classes, types and the types' matrices; the annotators' types."""

    def __init__(self, n_annotators: int, k: int, types: int):
        self.a, self.k, self.m = n_annotators, k, min(types, n_annotators)
        self.prior = np.full((k, k), 0.5) + np.eye(k) * 1.5

    def first(self, counts: np.ndarray, classes: np.ndarray) -> None:
        """Types from the annotators' agreement with the majority: equal parts from worst to best."""
        right = np.einsum("akk->a", counts) / np.maximum(counts.sum((1, 2)), 1e-9)
        rank = np.argsort(np.argsort(right, kind="stable"), kind="stable")
        self.types = np.full((self.a, self.m), 0.1 / self.m)
        self.types[np.arange(self.a), rank * self.m // self.a] += 0.9
        self._matrices(counts, classes)

    def _matrices(self, counts: np.ndarray, classes: np.ndarray) -> None:
        self.shared = self.prior + np.einsum("am,akv->mkv", self.types, counts)
        self.sizes = 1.0 + self.types.sum(0)
        self.class_size = 1.0 + classes
        self.log_class = _mean_log(self.class_size)
        self.log_conf = np.einsum("am,mkv->akv", self.types, _mean_log(self.shared))

    def update(self, counts: np.ndarray, classes: np.ndarray) -> None:
        """Types, then matrices and weights, each at its best given the others and the items."""
        score = _mean_log(self.sizes) + np.einsum("akv,mkv->am", counts, _mean_log(self.shared))
        score -= score.max(1, keepdims=True)
        self.types = np.exp(score) / np.exp(score).sum(1, keepdims=True)
        self._matrices(counts, classes)

    def bound(self, log_weights: float) -> float:
        """The evidence bound right after the items' update, whose log weights are summed."""
        t = np.clip(self.types, 1e-300, 1)
        types = float((self.types * (np.log(t) - _mean_log(self.sizes))).sum())
        return log_weights - types - _divergence(self.shared, self.prior) - _divergence(self.class_size, np.ones(self.k)) - _divergence(self.sizes, np.ones(self.m))

    def matrices(self) -> np.ndarray:
        """Expected confusion matrix of each annotator."""
        return np.einsum("am,mkv->akv", self.types, self.shared / self.shared.sum(2, keepdims=True))


def consensus(labels: DataFrame, classes=CLASSES, types: int = TYPES, least: int = 3, bounds: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(decided, reliability) from ``latest_labels`` rows.

    decided: item, consensus, certainty, n_annotators. reliability: annotator, n_labels, type,
    reliability (mean probability of giving the right label over the classes), agreement with consensus.
    The evidence bounds of the passes are put into ``bounds`` if it is given.
    """
    spark, k = labels.sparkSession, len(classes)
    who = labels.select("annotator").distinct().orderBy("annotator").limit(MAX_ANNOTATORS + 1).toPandas()["annotator"].tolist()
    if len(who) > MAX_ANNOTATORS:
        raise ValueError(f"more than {MAX_ANNOTATORS} annotators")
    if not who:
        kind = labels.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], f"item {kind}, consensus string, certainty double, n_annotators int"), spark.createDataFrame([], "annotator string, n_labels bigint, type int, reliability double, agreement double")
    index = spark.createDataFrame(list(enumerate(who)), "a int, annotator string")
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")).cast("int") - 1
    rows = labels.join(F.broadcast(index), "annotator").select("item", F.struct("a", code.alias("v")).alias("l"))
    items = rows.groupBy("item").agg(F.array_sort(F.collect_set("l")).alias("l")).select("item", F.col("l.a").alias("a"), F.col("l.v").alias("v"))
    items = written(items, "labelled-items")  # at most one label for each annotator, so the arrays are bounded

    size = len(who) * k * k

    def expected(model: Model | None) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Confusion counts of the annotators, sums of the items' classes, sum of the items' log weights, items."""
        state = spark.sparkContext.broadcast(None if model is None else (model.log_class, model.log_conf))

        def run(batches):
            total, sums = np.zeros((len(who), k, k)), np.zeros(k + 2)
            for pdf in batches:
                if len(pdf):
                    a, v, start, n = _flat(pdf)
                    if state.value is None:
                        votes = np.add.reduceat(np.eye(k)[v], start, axis=0)
                        q, weight = votes / votes.sum(1, keepdims=True), np.zeros(len(n))
                    else:
                        q, weight = posteriors(a, v, start, *state.value)
                    np.add.at(total, (a, slice(None), v), np.repeat(q, n, axis=0))
                    sums += [*q.sum(0), weight.sum(), len(n)]
            flat = np.concatenate([total.ravel(), sums])
            at = np.flatnonzero(flat)
            yield pd.DataFrame({"i": at, "x": flat[at]})

        sums = items.select("a", "v").mapInPandas(run, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        out = np.zeros(size + k + 2)
        out[sums["i"].to_numpy(int)] = sums["x"].to_numpy(float)
        return out[:size].reshape(len(who), k, k), out[size : size + k], out[size + k], out[size + k + 1]

    model = Model(len(who), k, types)
    model.first(*expected(None)[:2])
    before = -math.inf
    while True:
        counts, sums, weights, n_items = expected(model)
        bound = model.bound(weights)
        if bounds is not None:
            bounds.append(bound)
        if bound - before < LEAST_GAIN * n_items:
            break
        before = bound
        model.update(counts, sums)
    final = spark.sparkContext.broadcast((model.log_class, model.log_conf))

    def decide(batches):
        for pdf in batches:
            if len(pdf):
                a, v, start, n = _flat(pdf)
                q, _ = posteriors(a, v, start, *final.value)
                best = q.argmax(1)
                yield pd.DataFrame({"item": pdf["item"], "consensus": [classes[b] for b in best], "certainty": q.max(1), "n_annotators": n})

    kind = labels.schema["item"].dataType.simpleString()
    decided = items.mapInPandas(decide, f"item {kind}, consensus string, certainty double, n_annotators int").where(F.col("n_annotators") >= least)
    right = np.einsum("akk->ak", model.matrices()).mean(1)
    made = counts.sum((1, 2))
    agree = np.einsum("akk->a", counts) / np.maximum(made, 1e-9)
    reliability = spark.createDataFrame(
        [(w, int(round(made[i])), int(model.types[i].argmax()), float(round(right[i], 6)), float(round(agree[i], 6))) for i, w in enumerate(who)],
        "annotator string, n_labels bigint, type int, reliability double, agreement double",
    )
    return decided, reliability


def pairwise_kappa(labels: DataFrame) -> DataFrame:
    """Agreement of each pair of annotators: n_items, observed, expected, kappa (1 if expected is 1)."""
    per_item = labels.groupBy("item").agg(F.array_sort(F.collect_set(F.struct("annotator", "label"))).alias("l"))
    pairs = per_item.select(F.explode(F.expr("flatten(transform(l, (x, i) -> transform(slice(l, i + 2, size(l)), y -> struct(x.annotator as a, y.annotator as b, x.label as p, y.label as q))))")).alias("x")).select("x.*")
    table_ = pairs.groupBy("a", "b", "p", "q").agg(F.count("*").alias("n"))  # bounded by annotators and classes
    sums = table_.groupBy("a", "b").agg(F.sum("n").alias("n_items"), F.sum(F.when(F.col("p") == F.col("q"), F.col("n")).otherwise(0)).alias("n_agree"))
    left = table_.groupBy("a", "b", F.col("p").alias("c")).agg(F.sum("n").alias("np"))
    right = table_.groupBy("a", "b", F.col("q").alias("c")).agg(F.sum("n").alias("nq"))
    chance = left.join(right, ["a", "b", "c"]).groupBy("a", "b").agg(F.sum(F.col("np") * F.col("nq")).alias("cross"))
    out = sums.join(chance, ["a", "b"], "left")
    po, pe = F.col("n_agree") / F.col("n_items"), F.coalesce("cross", F.lit(0)) / (F.col("n_items") * F.col("n_items"))
    kappa = F.when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe))
    return out.select(F.col("a").alias("curator_a"), F.col("b").alias("curator_b"), "n_items", F.round(po, 4).alias("observed"), F.round(pe, 4).alias("expected"), F.round(kappa, 4).alias("kappa"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_labels(table(spark, sf_dir, "curation_decision"), "pattern_id", "curator", "decision", "decided_at")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided, _ = consensus(written(_labels(spark, sf_dir), "labels"))
    return decided.select(F.col("item").alias("pattern_id"), "consensus")


def p3_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus(written(_labels(spark, sf_dir), "labels"))[1].withColumnRenamed("annotator", "curator")


def p3_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_kappa(_labels(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_reliability": p3_reliability, "p3_kappa": p3_kappa}
ORACLES = {
    "p3_kappa": r"""
WITH c AS (SELECT pattern_id, curator, decided_at, lower(trim(decision)) AS d FROM curation_decision),
n AS (SELECT pattern_id, curator, decided_at, CASE d WHEN 'keep' THEN 'strip' WHEN 'remove' THEN 'skip' ELSE d END AS d FROM c),
l AS (SELECT pattern_id, curator, d FROM n WHERE d IN ('strip', 'skip', 'modify', 'substitute')
      QUALIFY row_number() OVER (PARTITION BY pattern_id, curator ORDER BY decided_at DESC, d DESC) = 1),
p AS (SELECT a.curator AS ca, b.curator AS cb, a.d AS p, b.d AS q FROM l a JOIN l b ON a.pattern_id = b.pattern_id AND a.curator < b.curator),
s AS (SELECT ca, cb, count(*) AS n, avg(CASE WHEN p = q THEN 1.0 ELSE 0.0 END) AS po FROM p GROUP BY 1, 2),
e AS (SELECT s.ca, s.cb, sum((SELECT count(*) FROM p WHERE p.ca = s.ca AND p.cb = s.cb AND p.p = k.d) * (SELECT count(*) FROM p WHERE p.ca = s.ca AND p.cb = s.cb AND p.q = k.d)) / (max(s.n) * max(s.n)) AS pe
      FROM s, (SELECT unnest(['strip', 'skip', 'modify', 'substitute']) AS d) k GROUP BY 1, 2)
SELECT s.ca AS curator_a, s.cb AS curator_b, s.n AS n_items, round(po, 4) AS observed, round(pe, 4) AS expected,
  round(CASE WHEN pe >= 1 THEN 1.0 ELSE (po - pe) / (1 - pe) END, 4) AS kappa
FROM s JOIN e ON s.ca = e.ca AND s.cb = e.cb"""
}
