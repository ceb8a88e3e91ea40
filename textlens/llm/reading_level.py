"""Reading band of each document by a familiar-word formula (problem 10).

Two figures describe a text: the share of its words outside a list of familiar words, and its average
sentence length. The list is the head of the corpus's words by document frequency, counted over all
documents of the language; its length (at most ``max(SIZES)`` words, so broadcasting it is bounded) and
the weights of the two figures are fitted on labelled passages by discriminant analysis, the list's
length by the best leave-one-out likelihood. Labelled rows are read up to ``max_labels`` (10,000).

Sentences end at ``.!?`` before white space and a capital, at blank lines, at list items, and at line
breaks before a capital where full stops are missing; hard-wrapped lines go on in lower case. Known
abbreviations end no sentence. Pieces of fewer than four words without an end mark (headings, labels)
are no sentences.

Nulls and empty texts have no band (they give no rows in ``bands``). A tie between bands goes to the
lower. Very long texts are read whole. Repeated rows give repeated rows. Without labels of at least two
passages in some band ``fit`` raises ValueError. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.session import table

SIZES = (100, 150, 200, 250, 300, 350, 400, 500, 700, 1000)
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_ABBREVIATION = re.compile(r"\b(?:e\.g|i\.e|cf|approx|vs|etc|no|fig|dr|mr|mrs|ms|st|al)\.$", re.I)
_ITEM = re.compile(r"^\s*(?:[-*+•–]|\(?\d{1,3}[.)]|\(?[a-z][.)])\s+")
_END = re.compile(r"[.!?]+[\"')\]]*(?=\s+[\"'(\[]?[A-Z])|$")


def sentences(text: str) -> list[str]:
    caps, parts, current = text.upper() == text, [], []

    def close():
        if current:
            parts.append(" ".join(current))
            current.clear()

    for line in text.replace("\r", "\n").split("\n"):
        s = line.strip()
        if not s:
            close()
        elif m := _ITEM.match(line):
            close()
            current.append(line[m.end() :].strip())
        else:
            if current and not caps and not (s[0].islower() or s[0].isdigit()):
                close()
            current.append(s)
    close()
    out = []
    for part in parts:
        start = 0
        for m in _END.finditer(part):
            if m[0] and _ABBREVIATION.search(part, max(start, m.start() - 12), m.start() + 1):
                continue
            if piece := part[start : m.end()].strip():
                out.append(piece)
            start = m.end()
    return out


def figures(text: str, familiar: frozenset[str]) -> tuple[float, float]:
    """(share of unfamiliar words, average sentence length)."""
    words = WORD.findall(text.lower())
    lengths = [n for s in sentences(text) if (n := len(WORD.findall(s))) >= 4 or (n and s[-1] in ".!?")]
    known = sum(map(familiar.__contains__, words))
    return 1 - known / max(1, len(words)), (sum(lengths) / len(lengths) if lengths else max(1, len(words)))


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, df) over all documents; each task sends partial counts, not one row for each word."""

    def partial(batches):
        seen: Counter = Counter()
        for pdf in batches:
            for t in pdf[text]:
                if t:
                    seen.update(set(WORD.findall(t.lower())))
            if len(seen) > 200_000:
                yield pd.DataFrame(list(seen.items()), columns=["word", "df"])
                seen.clear()
        yield pd.DataFrame(list(seen.items()), columns=["word", "df"])

    return docs.select(text).mapInPandas(partial, "word string, df bigint").groupBy("word").agg(F.sum("df").alias("df"))


@dataclass(frozen=True)
class BandModel:
    familiar: frozenset[str]
    bands: tuple[int, ...]
    means: np.ndarray
    inverse: np.ndarray

    def band(self, text: str) -> int:
        share, length = figures(text, self.familiar)
        d = np.array([share, np.log(length)]) - self.means
        return self.bands[int(np.argmin(np.einsum("ij,jk,ik->i", d, self.inverse, d)))]


def _fit(x: np.ndarray, y: np.ndarray, bands: list[int]) -> tuple[np.ndarray, np.ndarray]:
    means = np.array([x[y == b].mean(0) for b in bands])
    rest = x - means[np.searchsorted(bands, y)]
    return means, np.linalg.inv(rest.T @ rest / max(1, len(x) - len(bands)) + 1e-4 * np.eye(x.shape[1]))


def fit(frequencies: DataFrame, labels: DataFrame, max_labels: int = 10_000) -> BandModel:
    """labels: columns text and band."""
    head = [r.word for r in frequencies.orderBy(F.desc("df"), "word").limit(max(SIZES)).collect()]
    rows = labels.select("text", "band").where("text is not null and band is not null").limit(max_labels).collect()
    y = np.array([r.band for r in rows])
    bands = sorted({int(b) for b in y if (y == b).sum() > 1})
    if not bands:
        raise ValueError("each band needs two labelled passages or more")
    keep = np.isin(y, bands)
    y, texts = y[keep], [r.text for r, k in zip(rows, keep) if k]
    best = None
    for size in SIZES:
        familiar = frozenset(head[:size])
        x = np.array([figures(t, familiar) for t in texts])
        x[:, 1] = np.log(x[:, 1])
        loss = 0.0
        for i in range(len(y)):
            m, p = _fit(x[np.arange(len(y)) != i], y[np.arange(len(y)) != i], bands)
            d = x[i] - m
            score = -0.5 * np.einsum("ij,jk,ik->i", d, p, d)
            loss -= score[bands.index(y[i])] - np.logaddexp.reduce(score)
        if best is None or loss < best[0]:
            best = loss, BandModel(familiar, tuple(bands), *_fit(x, y, bands))
        if size >= len(head):
            break
    return best[1]


def bands(docs: DataFrame, model: BandModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, band) of every document whose text is not null or blank."""

    @F.pandas_udf("int")
    def band(texts: pd.Series) -> pd.Series:
        return texts.map(model.band)

    return docs.where(F.expr(rf"`{text}` rlike '\\S'")).select(key, band(text).alias("band"))


def p10_found(spark: SparkSession, sf_dir: str, min_words: int = 40) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "text")
    model = fit(document_frequencies(docs), table(spark, sf_dir, "reading_labels"))
    long = docs.where(F.size(F.split(F.trim(F.regexp_replace("text", r"(?U)^\s+|\s+$", "")), r"(?U)\s+")) >= min_words)
    return bands(long, model).distinct()


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source and band: the whole corpus, every language, judged by the model of the labelled language."""
    docs = table(spark, sf_dir, "documents")
    model = fit(document_frequencies(docs.where("lang = 'en'")), table(spark, sf_dir, "reading_labels"))
    with_source = docs.select(F.struct("doc_id", "source").alias("k"), "text")
    return bands(with_source, model, "k").groupBy("k.source", "band").agg(F.count("*").alias("n_documents"))


QUERIES = {"p10_found": p10_found, "p10_profile": p10_profile}
