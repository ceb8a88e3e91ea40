"""Records whose word sets are alike beyond a Jaccard threshold, by deletion-variant signatures (problem 7).

A word set is a sparse bit vector, and a Jaccard similarity of t or more bounds the number of bits two
sets of sizes a and b differ in: H <= (1-t)/(1+t) * (a+b). Cut into m = H // 2 + 1 segments, two such
sets have at least one segment that differs by one bit at most; so the segment itself and its
one-deletion variants (one word wild) meet in an equality join, and no similar pair is missed. Sets are
indexed by size class (a class ends where t times the end equals its start), so that H and m fit the
sizes and partners lie in the same or the next class.

* Copies (equal word sets) are one class with members; only classes are compared.
* Which word lies in which segment is free. It is balanced on a sample of at most ``SAMPLE`` sets
  (documented bound, touches speed only), so that each segment of a typical set holds informative words.
* A signature shared by more than ``hot`` rows (boilerplate only) is joined again on (signature, word)
  for the words of a prefix in one global order, rarest in the sample first: two similar sets share a
  word of their prefixes, so this is exact as well, and no bucket emits all its pairs.
* Candidates are pruned in the join by a 128-bit sketch (differing bits never exceed differing words)
  and verified on the words themselves.

Words are runs of letters and digits in lower case. Nulls and names without a word have no pairs. Repeated
rows count once. Two names of one key do not pair. Empty input gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.session import discard, table, written

SAMPLE = 4_000
_M64 = (1 << 64) - 1


def code(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def size_classes(largest: int, t: float) -> list[tuple[int, int]]:
    out, low = [], 1
    while low <= largest:
        high = max(low, math.floor(low / t + 1e-9))
        out.append((low, high))
        low = high + 1
    return out


def most_different(a: int, b: int, t: float) -> int:
    return math.floor((1 - t) / (1 + t) * (a + b) + 1e-9)


def balanced(sample: list[list[str]], m: int, seed: int = 1) -> dict[str, int]:
    """Segment of each word of the sample: the most informative words first, each to the segment that
    holds least information in the sets the word occurs in."""
    df: Counter = Counter(w for s in sample for w in s)
    where = defaultdict(list)
    for i, s in enumerate(sample):
        for w in s:
            where[w].append(i)
    n, rnd, out = len(sample), random.Random(seed), {}
    load = [[0.0] * m for _ in sample]
    info = {w: math.log2((n + 1) / c) for w, c in df.items()}
    for w in sorted(df, key=lambda w: (-df[w] * info[w], w)):
        rows = where[w] if len(where[w]) <= 200 else rnd.sample(where[w], 200)
        total = [0.0] * m
        for i in rows:
            for k in range(m):
                total[k] += load[i][k]
        best = min(range(m), key=total.__getitem__)
        out[w] = best
        for i in where[w]:
            load[i][best] += info[w]
    return out


class Index:
    """What a worker needs to emit signatures: for each size class its m, and the words' segments."""

    def __init__(self, sizes: dict[int, int], t: float, sample: list[list[str]]):
        self.t = t
        self.classes = size_classes(max(sizes), t)
        self.of_size = {s: i for i, (a, b) in enumerate(self.classes) for s in range(a, b + 1)}
        self.present = {self.of_size[s] for s in sizes}
        self.m = {i: most_different(b, b, t) // 2 + 1 for i, (_, b) in enumerate(self.classes)}
        self.segments = {}
        for i in self.present:
            low, high = self.classes[max(0, i - 1)][0], self.classes[i][1]
            near = [s for s in sample if low <= len(s) <= high]
            self.segments[i] = balanced(near, self.m[i]) if near and 1 < self.m[i] <= 64 else {}  # very long texts: by hash
        df: Counter = Counter(w for s in sample for w in s)
        self.rank = {w: (c, code(w)) for w, c in df.items()}
        self.salts: dict[tuple[int, int], int] = {}

    def emit(self, words: list[str]) -> np.ndarray:
        """Signatures in the indexes of the set's class and of the next; the last two bits tell own class and whole segment."""
        own, codes, out = self.of_size[len(words)], [(w, code(w)) for w in words], []
        for i in (own, own + 1):
            if i not in self.present:
                continue
            m, table_ = self.m[i], self.segments[i]
            parts: list[list[int]] = [[] for _ in range(m)]
            for w, c in codes:
                parts[table_.get(w, c % m)].append(c)
            for k, part in enumerate(parts):
                x = sum(part) & _M64
                x = np.uint64(x) - np.array([0, *part], np.uint64) ^ np.uint64(self.salt(i, k))
                x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(29))) & np.uint64(_M64 - 3) | np.uint64(2 * (i == own))
                x[0] |= np.uint64(1)
                out.append(x)
        return np.concatenate(out).view(np.int64)

    def salt(self, i: int, k: int) -> int:
        if (i, k) not in self.salts:
            self.salts[i, k] = code(f"{i}/{k}")
        return self.salts[i, k]

    def prefix(self, words: list[str]) -> list[int]:
        p = len(words) - math.ceil(self.t * len(words) - 1e-9) + 1
        first = sorted(words, key=lambda w: self.rank.get(w) or (0, code(w)))[:p]
        return [code(w) - (1 << 63) for w in first]


def word_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """(set_id, key, words): distinct keys and texts with the sorted distinct words and their identity."""
    words = F.array_sort(F.array_distinct(F.expr(rf"regexp_extract_all(lower(`{text}`), '(?U)[\\p{{L}}\\p{{N}}]+', 0)")))
    rows = df.select(F.col(key).alias("key"), words.alias("words")).where("key is not null and size(words) > 0")
    return rows.select(F.unhex(F.md5(F.array_join("words", " "))).alias("set_id"), "key", "words").distinct()


def similar_sets(sets: DataFrame, t: float, hot: int = 256) -> DataFrame:
    """(a, b), a < b: pairs of set_id whose words have a Jaccard similarity of t or more."""
    spark = sets.sparkSession
    sizes = {r.n: r.c for r in sets.groupBy(F.size("words").alias("n")).agg(F.count("*").alias("c")).collect()}  # a row for each size
    nothing = spark.createDataFrame([], "a binary, b binary")
    if not sizes:
        return nothing
    sample = [r.words for r in sets.orderBy(F.xxhash64("set_id")).limit(SAMPLE).select("words").collect()]
    index = spark.sparkContext.broadcast(Index(sizes, t, sample))  # bounded by SAMPLE sets

    @F.pandas_udf("array<bigint>")
    def emit(s: pd.Series) -> pd.Series:
        return s.map(lambda w: index.value.emit(list(w)))

    @F.pandas_udf("array<bigint>")
    def prefix(s: pd.Series) -> pd.Series:
        return s.map(lambda w: index.value.prefix(list(w)))

    bit = lambda half: F.aggregate("words", F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseOR(F.when(F.pmod(F.xxhash64(w), F.lit(2)) == half, F.expr("1L")).otherwise(F.expr("0L")) * F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(w, F.lit(1)), F.lit(64)).cast("int"))))
    # a set is a number from here on: rows of signatures are five numbers
    named = written(sets.select("set_id", "words").withColumn("id", F.monotonically_increasing_id()), "named-sets")
    rows = named.select("id", F.size("words").alias("n"), bit(0).alias("s0"), bit(1).alias("s1"), F.explode(emit("words")).alias("e"))
    three = F.lit(3).cast("bigint")
    rows = written(rows.select((F.col("e") - F.col("e").bitwiseAND(three)).alias("sig"), "id", (F.col("n") * 4 + F.col("e").bitwiseAND(three).cast("int")).alias("nf"), "s0", "s1"), "signatures")
    busy = written(rows.groupBy("sig").agg(F.count("*").alias("c")).where(F.col("c") > hot).select("sig"), "busy-signatures")
    share = (1 - t) / (1 + t)

    def meet(x: DataFrame, on: list[str]) -> DataFrame:
        left, right = x.where("nf & 2 = 2").alias("x"), x.alias("y")
        near = F.expr(f"""
            (x.nf | y.nf) & 1 = 1 and x.id <> y.id
            and (y.nf & 2 = 0 or x.nf & 1 = 1 and (y.nf & 1 = 0 or x.id < y.id))
            and least(x.nf >> 2, y.nf >> 2) >= {t} * greatest(x.nf >> 2, y.nf >> 2) - 1e-9
            and bit_count(x.s0 ^ y.s0) + bit_count(x.s1 ^ y.s1) <= {share} * ((x.nf >> 2) + (y.nf >> 2)) + 1e-9""")
        keys = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on]
        return left.join(right, keys + [near]).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    if busy.isEmpty():
        pairs = meet(rows, ["sig"]).distinct()
    else:
        # only the rows of busy signatures ever carry prefix words
        heads = named.select("id", F.explode(prefix("words")).alias("word"))
        warm = rows.join(busy, "sig", "left_semi").join(heads, "id")
        pairs = meet(rows.join(busy, "sig", "left_anti"), ["sig"]).unionByName(meet(warm, ["sig", "word"])).distinct()
    one, two = (named.select(F.col("id").alias(c), F.col("words").alias(f"{c}_words"), F.col("set_id").alias(f"{c}_set")) for c in ("a", "b"))
    both = F.size(F.array_intersect("a_words", "b_words"))
    alike = pairs.join(one, "a").join(two, "b").where(both >= t * (F.size("a_words") + F.size("b_words") - both) - 1e-9)
    out = written(alike.select(F.least("a_set", "b_set").alias("a"), F.greatest("a_set", "b_set").alias("b")), "similar-sets")
    discard(rows, busy, named)
    return out


def near_duplicates(df: DataFrame, key: str, text: str, t: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(members (set_id, key), links (a, b)): classes of equal word sets, and the pairs of similar classes."""
    rows = written(word_sets(df, key, text), "word-sets")
    members = rows.select("set_id", "key").distinct()
    return members, similar_sets(rows.select("set_id", "words").distinct(), t)


def expanded(members: DataFrame, links: DataFrame) -> DataFrame:
    """(key_a, key_b), key_a < key_b: all pairs of different keys, in equal or linked classes."""
    pair = lambda p: p.where("x <> y").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))
    x, y = members.withColumnRenamed("key", "x"), members.withColumnRenamed("key", "y")
    equal = x.join(y, "set_id").where("x < y")
    linked = links.join(x, links.a == x.set_id).drop("set_id").join(y, F.col("b") == y.set_id)
    return pair(equal).unionByName(pair(linked)).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, links = near_duplicates(table(spark, sf_dir, "duplicates_manifest"), "tinyId", "name")
    return expanded(members, links).select(F.col("key_a").alias("tinyid_a"), F.col("key_b").alias("tinyid_b"))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each record: its class and the number of similar classes."""
    members, links = near_duplicates(table(spark, sf_dir, "duplicates_manifest"), "tinyId", "name")
    ends = links.select(F.col("a").alias("set_id")).unionAll(links.select(F.col("b").alias("set_id")))
    degree = ends.groupBy("set_id").agg(F.count("*").alias("n_links"))
    return members.join(degree, "set_id", "left").select(F.col("key").alias("tinyId"), F.hex("set_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


QUERIES = {"p7_found": p7_found, "p7_groups": p7_groups}
ORACLES = {
    "p7_found": r"""
WITH w AS (SELECT DISTINCT tinyId, list_sort(list_distinct(regexp_extract_all(lower(name), '[\p{L}\p{N}]+'))) AS ws FROM duplicates_manifest WHERE tinyId IS NOT NULL AND name IS NOT NULL),
u AS (SELECT tinyId, ws, len(ws) AS n, unnest(ws) AS word FROM w),
c AS (SELECT a.tinyId AS tinyid_a, b.tinyId AS tinyid_b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
      FROM u a JOIN u b ON a.word = b.word AND a.tinyId < b.tinyId GROUP BY 1, 2)
SELECT tinyid_a, tinyid_b FROM c WHERE shared >= 0.7 * (na + nb - shared) - 1e-9""",
    "p7_groups": r"""
WITH w AS (SELECT DISTINCT tinyId, list_sort(list_distinct(regexp_extract_all(lower(name), '[\p{L}\p{N}]+'))) AS ws FROM duplicates_manifest WHERE tinyId IS NOT NULL AND name IS NOT NULL),
m AS (SELECT tinyId, ws, upper(md5(array_to_string(ws, ' '))) AS class_id FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT class_id, ws, len(ws) AS n FROM m), u AS (SELECT class_id, n, unnest(ws) AS word FROM s),
c AS (SELECT a.class_id AS x, b.class_id AS y, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM u a JOIN u b ON a.word = b.word AND a.class_id < b.class_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c WHERE shared >= 0.7 * (na + nb - shared) - 1e-9), d AS (SELECT i, count(*) AS n FROM (SELECT x AS i FROM l UNION ALL SELECT y FROM l) GROUP BY 1)
SELECT DISTINCT m.tinyId, m.class_id, coalesce(d.n, 0) AS n_links FROM m LEFT JOIN d ON d.i = m.class_id""",
}
