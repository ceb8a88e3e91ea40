"""Mixing sources to target shares of all tokens, by iterative proportional fitting (problem 9).

Documents fall into cells (source, language, topic). The cells' token totals are one small table, its
size bounded by ``MAX_CELLS`` (checked); weights on it are raked to the source shares, the language
shares and the topic shares in turn until they settle, each cell's weight capped at the source's
max_repeats. A cell's weight is the expected number of copies of its documents: the whole part is taken
for every document, the fraction by a hash of the document id. The hash threshold is calibrated for each
source on a histogram of token mass by hash (``BINS`` bins), so that the reached size meets the target
closely and not only in expectation.

A target source without documents cannot contribute; its share goes to the others in proportion, and
the report shows it with reached share 0. Documents of no listed source (or null) take no part. A
source that its cap holds below its target keeps the cap; the others fill up the total. Languages and
topics keep their shares in the listed sources unless targets are given. Topics are learned from the
documents (``learn_topics``). Null languages form the language 'und', documents without a topic word the
topic 'none'. Rows equal in the id count once. Empty
tables give empty tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.llm.reading_level import WORD, document_frequencies
from textlens.llm.tokens import TOKENIZER, encoder
from textlens.session import table, written

MAX_CELLS, BINS = 20_000, 2_048
TOPICS, VOCABULARY, RARE, COMMON = 6, 400, 0.005, 0.2


def cooccurring(docs: DataFrame, words: list[str]) -> np.ndarray:
    """In how many documents each pair of the words stands together (diagonal: each word); words x words is all the driver sees."""
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def partial(batches):
        index, total = shared.value, np.zeros((len(words), len(words)))
        for pdf in batches:
            for at in range(0, len(pdf), 1_000):
                some = pdf["text"].iloc[at : at + 1_000]
                x = np.zeros((len(some), len(words)), np.float32)
                for i, t in enumerate(some):
                    if t:
                        x[i, [index[w] for w in set(WORD.findall(t.lower())) if w in index]] = 1
                total += x.T @ x
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": i, "j": j, "n": total[i, j]})

    sums = docs.select("text").mapInPandas(partial, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((len(words), len(words)))
    out[sums["i"], sums["j"]] = sums["n"]
    return out


def learn_topics(docs: DataFrame, topics: int = TOPICS, vocabulary: int = VOCABULARY) -> dict[str, int]:
    """word -> topic, from all documents: words that keep the same company belong to one topic.

    The words are the ``vocabulary`` most frequent ones that are neither rare nor common by their share of
    documents. They are grouped by positive pointwise mutual information (its leading eigenvectors, k-means
    from far-apart starts). Without such words every document has topic 'none'.
    """
    n = docs.where("text is not null").count()
    middle = document_frequencies(docs).where((F.col("df") >= max(2, RARE * n)) & (F.col("df") <= COMMON * n) & (F.length("word") >= 4))
    words = [r.word for r in middle.orderBy(F.desc("df"), "word").limit(vocabulary).collect()]
    if len(words) < topics:
        return {}
    together = cooccurring(docs, words)
    df = np.diag(together)
    pmi = np.log(np.maximum(together * n, 1e-9) / np.outer(df, df))
    pmi[(pmi < 0) | (together == 0)] = 0
    np.fill_diagonal(pmi, 0)
    value, vector = np.linalg.eigh(pmi)
    x = vector[:, -topics:] * np.sqrt(np.maximum(value[-topics:], 0))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centres = [x[0]]
    while len(centres) < topics:
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, axis=1))])
    centres = np.array(centres)
    of = None
    for _ in range(100):  # k-means of at most ``vocabulary`` points; a stop before it settles is a topic set as well
        new = np.argmax(x @ centres.T, axis=1)
        if of is not None and (new == of).all():
            break
        of = new
        centres = np.array([x[of == k].mean(0) if (of == k).any() else centres[k] for k in range(topics)])
    return {w: int(k) for w, k in zip(words, of)}


def topic(text: str | None, words: dict[str, int]) -> str:
    """The topic whose words are used most, the lowest in a tie, 'none' without any."""
    n: dict[int, int] = {}
    for w in WORD.findall((text or "").lower()):
        if (k := words.get(w)) is not None:
            n[k] = n.get(k, 0) + 1
    return f"t{min(n, key=lambda k: (-n[k], k))}" if n else "none"


def described(docs: DataFrame, tokenizer: str = TOKENIZER, topics: dict[str, int] | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) of documents with a source; topics as ``learn_topics`` gives them, by default learned here."""
    rows = docs.where("source is not null")
    words = docs.sparkSession.sparkContext.broadcast(learn_topics(rows) if topics is None else topics)  # bounded by VOCABULARY

    @F.pandas_udf("struct<n_tokens:bigint,topic:string>")
    def describe(texts: pd.Series) -> pd.DataFrame:
        encode = encoder(tokenizer).encode_ordinary
        return pd.DataFrame({"n_tokens": [len(encode(t)) if t else 0 for t in texts], "topic": [topic(t, words.value) for t in texts]})

    rows = rows.select("doc_id", "source", F.coalesce("lang", F.lit("und")).alias("lang"), describe("text").alias("d"))
    return rows.select("doc_id", "source", "lang", "d.topic", "d.n_tokens")


def rake(cells: pd.DataFrame, targets: pd.DataFrame, total: float, langs: dict | None = None, topics: dict | None = None, rounds: int = 200) -> np.ndarray:
    """Expected copies of each cell (columns source, lang, topic, tokens) at a total size in tokens."""
    n = cells["tokens"].to_numpy(float)
    caps = dict(zip(targets["source"], targets["max_repeats"].astype(float)))
    cap = cells["source"].map(caps).to_numpy(float)
    have = cells.groupby("source")["tokens"].sum().to_dict()
    share = {s: t for s, t in zip(targets["source"], targets["target_share"].astype(float)) if have.get(s, 0) > 0}
    # the sizes the sources can reach: shares scaled up, capped ones held, until the total is met
    size, open_ = {}, dict(share)
    while open_:
        rest, scale = total - sum(size.values()), sum(open_.values())
        over = {s for s, t in open_.items() if rest * t / scale >= caps[s] * have[s]} if scale > 0 else set(open_)
        if not over:
            size |= {s: rest * t / scale for s, t in open_.items()}
            break
        for s in over:
            size[s] = caps[s] * have[s]
            del open_[s]
    whole = sum(size.values())
    marginals = [("source", size)]
    for column, wanted in (("lang", langs), ("topic", topics)):
        sums = cells.groupby(column)["tokens"].sum()
        wanted = wanted or (sums / sums.sum()).to_dict()
        marginals.append((column, {k: v * whole for k, v in wanted.items()}))
    marginals.append(marginals[0])  # source last: its shares are the ones promised
    w = np.ones(len(cells))
    for _ in range(rounds):
        before = w.copy()
        for column, wanted in marginals:
            keys = cells[column].to_numpy()
            for key, goal in wanted.items():
                at = keys == key
                for _ in range(20):  # mass that caps cut off goes to the cells still open
                    now = (w[at] * n[at]).sum()
                    if now <= 0 or abs(now - goal) <= 1e-9 * max(1.0, goal):
                        break
                    held = w[at] >= cap[at] - 1e-12 if goal > now else np.zeros(at.sum(), bool)
                    moving = (w[at] * n[at])[~held].sum()
                    if moving <= 0:
                        break
                    part = w[at]
                    part[~held] = np.minimum(part[~held] * (goal - now + moving) / moving, cap[at][~held])
                    w[at] = part
        if np.max(np.abs(w - before)) < 1e-7:
            break
    return w


def mixed(docs: DataFrame, targets: DataFrame, total: int | None = None, langs: dict | None = None, topics: dict | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, copies) with copies >= 1; docs as ``described`` gives them.

    total: size of the mixture in tokens, by default that of the documents of the listed sources.
    """
    spark = docs.sparkSession
    goals = targets.select("source", "target_share", "max_repeats").where("source is not null").limit(MAX_CELLS + 1).toPandas()
    if len(goals) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} target sources; mix groups of sources one after the other")
    names = [str(s) for s in goals["source"]]
    docs = docs.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)).dropDuplicates(["doc_id"])
    cells = docs.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic; fold rare languages or ask for fewer topics")
    cells = cells.sort_values(["source", "lang", "topic"], ignore_index=True)
    if cells.empty:
        return docs.select("doc_id", "source", "n_tokens", F.lit(0).alias("copies")).where("copies > 0")
    cells["w"] = rake(cells, goals, float(total or cells["tokens"].sum()), langs, topics)
    cells["base"] = np.floor(cells["w"] + 1e-9).astype(int)
    cells["frac"] = np.clip(cells["w"] - cells["base"], 0, 1)
    weights = spark.createDataFrame(cells[["source", "lang", "topic", "base", "frac"]], "source string, lang string, topic string, base int, frac double")
    u = (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    # a document takes its extra copy if v = u / frac is below its source's threshold, in expectation 1
    drawn = docs.join(F.broadcast(weights), ["source", "lang", "topic"]).withColumn("v", F.when(F.col("frac") > 1e-9, u / F.col("frac")))
    drawn = written(drawn.select("doc_id", "source", "n_tokens", "base", "v"), "drawn")
    bins = drawn.where("v < 2").groupBy("source", F.floor(F.col("v") * (BINS // 2)).cast("int").alias("bin")).agg(F.sum("n_tokens").alias("tokens")).toPandas()
    cells["extra"], cuts = cells["frac"] * cells["tokens"], []
    for source, part in cells.groupby("source"):
        goal, run, cut = part["extra"].sum(), 0.0, 0
        mass = bins[bins["source"] == source].set_index("bin")["tokens"].reindex(range(BINS), fill_value=0)
        for b, m in mass.items():
            if abs(run + m - goal) > abs(run - goal) and run + m > goal:
                break
            run, cut = run + m, b + 1
        cuts.append((source, cut / (BINS // 2)))
    limits = spark.createDataFrame(cuts, "source string, cut double")
    copies = F.col("base") + F.when(F.col("v") < F.col("cut"), 1).otherwise(0)
    return drawn.join(F.broadcast(limits), "source").select("doc_id", "source", "n_tokens", copies.alias("copies")).where("copies > 0")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each target source: target, size, share reached, most copies of one document."""
    reached = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"), F.count("*").alias("n_documents"))
    whole = reached.agg(F.sum("tokens").alias("whole"))
    rows = targets.select("source", "target_share", "max_repeats").join(reached, "source", "left").crossJoin(F.broadcast(whole))
    return rows.select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.round(F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)), 6).alias("share"))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    docs = written(described(table(spark, sf_dir, "documents")), "described")
    return mixed(docs, targets), targets


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(*_mixture(spark, sf_dir))


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
