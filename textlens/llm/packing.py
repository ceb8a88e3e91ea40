"""Documents into containers of a fixed token capacity, by linear grouping (problem 8).

A document larger than a container is cut into full containers and one rest; nothing else is split.
Items (the rests and all other documents) are dealt by a hash of their id to shards of about
``shard_items``, an expected size that does not grow with the corpus, so no task ever sees an unbounded
group and only ids and lengths move. Each shard is packed as follows:

1. Items above ``small`` of the capacity are sorted and cut into ``groups`` groups of equal cardinality;
   lengths round up to the largest of their group (linear grouping), which leaves few sizes.
2. The fractional cutting-stock problem over these sizes is solved by column generation; its
   configurations are used as often as the rounded-down solution says.
3. Actual documents take the places of their group's size, longest first; what rounding left over and
   the small items go best-fit into the containers, opening new ones where nothing fits.

Rows equal in the id count once. Null texts and texts of no tokens have size 0 and take no place (no
row). Ties in length go by id. An empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from textlens.llm.tokens import TOKENIZER, n_tokens
from textlens.session import table, written

CAPACITY = 4096


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 200) -> list[tuple[np.ndarray, float]]:
    """(configuration, times) of the fractional cutting-stock optimum, by column generation.

    sizes: distinct, each at most capacity. A configuration holds how many items of each size it takes.
    """
    k = len(sizes)
    unit = max(1, capacity // 1024)
    room, step = capacity // unit, [-(-s // unit) for s in sizes]
    step = [min(s, room) for s in step]
    columns = [np.eye(k)[i] * (room // step[i]) for i in range(k)]
    b = np.array(demand, float)
    for _ in range(rounds):
        basis = np.array(columns).T
        y = np.linalg.solve(basis.T, np.ones(k))
        # unbounded knapsack: best value at each size, and the item that reached it
        value, last = np.zeros(room + 1), np.full(room + 1, -1)
        for c in range(1, room + 1):
            value[c], last[c] = value[c - 1], -1
            for i in range(k):
                if step[i] <= c and (v := value[c - step[i]] + y[i]) > value[c] + 1e-12:
                    value[c], last[c] = v, i
        if value[room] <= 1 + 1e-7:
            break
        new, c = np.zeros(k), room
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                new[last[c]] += 1
                c -= step[last[c]]
        x, d = np.linalg.solve(basis, b), np.linalg.solve(basis, new)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        columns[out] = new
    x = np.linalg.solve(np.array(columns).T, b)
    return [(c.astype(int), float(t)) for c, t in zip(columns, x) if t > 1e-9]


def pack(lengths: list[int], capacity: int, groups: int = 24, small: float = 0.125) -> list[int]:
    """The container (from 0) of each item; lengths are between 1 and capacity."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    large = [i for i in order if lengths[i] > small * capacity]
    where, free = [-1] * len(lengths), []
    left: list[int] = []
    if large:
        per = math.ceil(len(large) / groups)
        cut = [large[i : i + per] for i in range(0, len(large), per)]
        merged: list[list[int]] = []  # groups of one rounded size are one
        for g in cut:
            if merged and lengths[merged[-1][0]] == lengths[g[0]]:
                merged[-1] += g
            else:
                merged.append(g)
        sizes = [lengths[g[0]] for g in merged]
        queues = [list(reversed(g)) for g in merged]
        for config, times in configurations(sizes, [len(g) for g in merged], capacity):
            for _ in range(int(times + 1e-6)):
                used, box = 0, len(free)
                for i in np.flatnonzero(config):
                    for _ in range(config[i]):
                        if queues[i]:
                            item = queues[i].pop()
                            where[item], used = box, used + lengths[item]
                if used:
                    free.append(capacity - used)
        left = [i for q in queues for i in q]
    rest = sorted(left + [i for i in order if lengths[i] <= small * capacity], key=lambda i: -lengths[i])
    spaces = sorted((f, box) for box, f in enumerate(free))
    for i in rest:
        at = bisect.bisect_left(spaces, (lengths[i], -1))
        if at < len(spaces):
            f, box = spaces.pop(at)
        else:
            f, box = capacity, len(free)
            free.append(capacity)
        where[i] = box
        bisect.insort(spaces, (f - lengths[i], box))
    return where


def packed(sizes: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, shard_items: int = 10_000) -> DataFrame:
    """(container, key, part, n_tokens): every item's container; part counts from 0 within a document."""
    kind = sizes.schema[key].dataType.simpleString()
    docs = sizes.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("n")).where("key is not null and n > 0")
    docs = docs.groupBy("key").agg(F.max("n").alias("n"))
    full = docs.where(F.col("n") > capacity).select("key", F.explode(F.expr(f"sequence(0, cast(n div {capacity} as int) - 1)")).alias("part"))
    full = full.select(F.concat_ws("/", F.lit("full"), "key", "part").alias("container"), "key", "part", F.lit(capacity).cast("bigint").alias("n"))
    rests = docs.select("key", F.when(F.col("n") > capacity, F.expr(f"n div {capacity}")).otherwise(0).cast("int").alias("part"), F.when(F.col("n") > capacity, F.expr(f"n % {capacity}")).otherwise(F.col("n")).alias("n")).where("n > 0")
    shards = max(1, math.ceil(rests.count() / shard_items))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        boxes = pack(pdf["n"].tolist(), capacity)
        return pd.DataFrame({"container": [f"{s}/{b}" for s, b in zip(pdf["shard"], boxes)], "key": pdf["key"], "part": pdf["part"], "n": pdf["n"]})

    dealt = rests.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).repartition(shards, "shard")  # a number: else tiny shards share one task
    shared = dealt.groupBy("shard").applyInPandas(lambda pdf: one(pdf), f"container string, key {kind}, part int, n bigint")
    return shared.unionByName(full).select("container", F.col("key").alias(key), "part", F.col("n").alias("n_tokens"))


def sized(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return written(docs.select("doc_id", n_tokens(F.col("text"), tokenizer).alias("n_tokens")), "sizes")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(sized(spark, sf_dir))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of capacity used."""
    boxes = packed(sized(spark, sf_dir)).groupBy("container").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n_items"))
    return boxes.agg(
        F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"),
        F.round(F.sum("used") / (F.count("*") * CAPACITY), 6).alias("share_used"),
    )


QUERIES = {"p8_pack": p8_pack, "p8_fill": p8_fill}
