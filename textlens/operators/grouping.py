"""Groups of phrases by common beginnings, temporal frames, contigs of overlapping windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlens.functions import text as tx
from textlens.session import discard, written

# Words that end no group label (fixed values).
# Temporal phrases that are expanded into their spellings (fixed values).
TEMPORAL_SEEDS = [
    "In the past 7 days", "In the last 12 months", "In the past year", "In the last 6 months", "During the past 4 weeks",
    "During the past 30 days", "Over the past month", "Over the past 2 weeks", "In the past 14 days", "In the past 3 months",
    "Within the last three months", "Over the past week", "In the past 3 years", "Over the past ten years", "In the last two months",
    "During the last 365 days", "During the past few weeks", "In the last few days", "Over the past few months", "In the past 90 days",
    "In the past 12 weeks", "In the last 3 weeks", "In the past 24 hours", "During the last 48 hours", "In the last 8 hours",
    "since the last visit",
]
FUNCTION_WORDS = "a an the of in on at by for to and or with from as is was were are be".split()


def prefix_groups(names: DataFrame, least: int = 2, least_words: int = 2) -> DataFrame:
    """(name, group_label): each name under its longest word prefix that ``least`` names share.

    Trailing function words and delimiters are trimmed from labels; names without a shared prefix are
    their own group.
    """
    t = F.split(F.trim(F.regexp_replace("name", r"\s+", " ")), " ")
    rows = names.select("name").where("name is not null").distinct()
    grams = rows.select("name", F.explode(F.transform(F.sequence(F.lit(1), F.size(t)), lambda n: F.struct(n.alias("k"), F.lower(F.array_join(F.slice(t, 1, n), " ")).alias("p")))).alias("g")).where(F.col("g.k") >= least_words)
    shared = grams.groupBy("g.p").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    best = grams.join(shared, F.col("g.p") == F.col("p")).groupBy("name").agg(F.max(F.struct("g.k", "p")).alias("b"))
    label = tx.cut_delimiters(F.regexp_replace(F.col("b.p"), r"(?:[\s\-–:;,]+(?:" + "|".join(FUNCTION_WORDS) + r"))+$", ""))
    return rows.join(best, "name", "left").select("name", F.coalesce(label, tx.cut_delimiters(F.lower("name"))).alias("group_label"))


def hierarchy(names: DataFrame, records: DataFrame, base: int = 2, scale: float = 0.0) -> DataFrame:
    """(group_label, name, suffix, n_ids): groups with enough records, members with what follows the label.

    records: (name, tinyId). The least support is base + floor(scale * sqrt(distinct records)).
    """
    total = records.agg(F.countDistinct("tinyId").alias("t"))
    groups = prefix_groups(names)
    ids = records.select("name", "tinyId").where("tinyId is not null").distinct()
    size = groups.join(ids, "name").groupBy("group_label").agg(F.countDistinct("tinyId").alias("group_ids"))
    enough = size.crossJoin(F.broadcast(total)).where(F.col("group_ids") >= base + F.floor(scale * F.sqrt("t")))
    n = ids.groupBy("name").agg(F.count("*").alias("n_ids"))
    suffix = tx.cut_delimiters(F.substring("name", F.length("group_label") + 1, F.length("name")))
    return groups.join(enough.select("group_label"), "group_label").join(n, "name", "left").select("group_label", "name", suffix.alias("suffix"), F.coalesce("n_ids", F.lit(0)).alias("n_ids"))


def temporal_class(c: Column) -> Column:
    """past, since, at, during or none: the frame of time a phrase opens with."""
    low = F.lower(c)
    return (
        F.when(low.rlike(r"\b(?:in|over|during|within) the (?:past|last|previous)\b"), "past").when(low.rlike(r"\bsince\b"), "since")
        .when(low.rlike(r"\bat (?:baseline|the time)\b"), "at").when(low.rlike(r"\b(?:during|within)\b"), "during").otherwise("none")
    )


def temporal_normal(c: Column) -> Column:
    """past / last / previous as past, their prepositions as in, a missing number as 1."""
    low = F.regexp_replace(F.lower(c), r"\b(?:in|over|during|within) the (?:past|last|previous)\b", "in the past")
    return F.regexp_replace(low, r"\bin the past (hour|day|week|month|year)\b", "in the past 1 $1")


def adjacent_prefix(names: DataFrame) -> DataFrame:
    """(name, shared): words shared with the alphabetically preceding name.

    Names are range-partitioned; each partition's first name looks at the last name of the nearest partition before it that has
    one. Only these last names, one a partition, come together.
    """
    t = F.split(F.lower("name"), r"\s+")
    rows = written(names.select("name").where("name is not null").distinct().repartitionByRange("name").withColumn("part", F.spark_partition_id()), "names")
    before = F.lag("name").over(Window.partitionBy("part").orderBy("name"))
    ends = rows.groupBy("part").agg(F.max("name").alias("end"))  # one row a partition
    edge = ends.withColumn("edge", F.lag("end").over(Window.orderBy("part"))).select("part", "edge")
    rows = rows.withColumn("before", before).join(F.broadcast(edge), "part").withColumn("before", F.coalesce("before", "edge"))
    u = F.split(F.lower("before"), r"\s+")
    same = F.filter(F.sequence(F.lit(1), F.least(F.size(t), F.size(u))), lambda n: F.slice(t, F.lit(1), n) == F.slice(u, F.lit(1), n))
    return rows.select("name", F.when(F.col("before").isNull(), 0).otherwise(F.size(same)).alias("shared"))


def chains(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root, dist): the head of each node's chain and the steps to it; links: (left, right), each node at most once on
    either side. Members of a ring have no root (null).

    Chains are contracted by pointer doubling, so rounds grow with the logarithm of the longest chain.
    """
    back = links.select(F.col("right").alias("node"), F.col("left").alias("root"))
    jump = written(nodes.select("node").distinct().join(back, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), 0).otherwise(1).cast("bigint").alias("dist")), "jump")
    for _ in range(links.count().bit_length() + 1):  # a chain of n links ends after log2(n) doublings; rings never do
        up = jump.select(F.col("node").alias("root"), F.col("root").alias("root2"), F.col("dist").alias("dist2"))
        new = written(jump.join(up, "root").select("node", "root", "root2", (F.col("dist") + F.col("dist2")).alias("dist")), "jump")
        still = new.where("root <> root2").isEmpty()
        discard(jump)
        jump = new.select("node", F.col("root2").alias("root"), "dist")
        jump._written_at = new._written_at
        if still:
            break
    ring = links.select(F.col("right").alias("root")).distinct().withColumn("ring", F.lit(True))
    return jump.join(ring, "root", "left").select("node", F.when(F.col("ring").isNull(), F.col("root")).alias("root"), "dist")


def _joined(lefts: DataFrame, rights: DataFrame) -> DataFrame:
    """(left, right) of nodes with one key, each used once: the i-th left end in alphabetical order takes the i-th right one.

    lefts, rights: (node, key). No key emits all its pairs.
    """
    rank = lambda df, c: df.select("key", F.col("node").alias(c), F.row_number().over(Window.partitionBy("key").orderBy("node")).alias("i"))
    return rank(lefts, "left").join(rank(rights, "right"), ["key", "i"]).where("left <> right").select("left", "right")


def _spelled(phrases: DataFrame, links: DataFrame, ids: DataFrame | None) -> DataFrame:
    """(phrase, k, count, n_ids): phrases (bin, phrase) joined along links (left, right, overlap)."""
    own = phrases.withColumn("node", F.concat_ws("\u0001", F.col("bin").cast("string"), "phrase"))
    at = chains(own.select("node"), links.select("left", "right"))
    cut = links.select(F.col("right").alias("node"), "overlap")
    body = own.join(at, "node").join(cut, "node", "left").select("node", "bin", "phrase", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), 0).otherwise(F.col("dist")).alias("dist"), F.when(F.col("root").isNull(), 0).otherwise(F.coalesce("overlap", F.lit(0))).alias("overlap"))
    rest = F.array_join(F.expr("slice(split(phrase, ' '), overlap + 1, size(split(phrase, ' ')))"), " ")
    text = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("dist", rest.alias("w")))), lambda x: x["w"]), lambda w: w != ""), " ")
    out = body.groupBy("root", F.col("bin").alias("count")).agg(text.alias("phrase"))
    if ids is None:
        return out.select("phrase", F.size(F.split("phrase", " ")).alias("k"), "count")
    n = body.join(ids, "phrase").groupBy("root").agg(F.countDistinct("tinyId").alias("n_ids"))
    return out.join(n, "root", "left").select("phrase", F.size(F.split("phrase", " ")).alias("k"), "count", F.coalesce("n_ids", F.lit(0)).alias("n_ids"))


def prune_contained(phrases: DataFrame) -> DataFrame:
    """phrases (phrase, k, count, ..) without those that are a run of words of a longer one with the same count."""
    from textlens.operators.mining import sub_windows

    inner = phrases.select("count", "phrase").distinct().join(sub_windows(phrases.select("phrase").distinct()).withColumnRenamed("long", "phrase"), "phrase")
    return phrases.join(inner.select("count", F.col("short").alias("phrase")).distinct(), ["count", "phrase"], "left_anti").select(*phrases.columns)


def longest_phrases(kmers: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(phrase, k, count, [n_ids]): windows of one length and count joined where all but one word overlap, on both sides, without what is contained.

    kmers: (kmer, count). ids: (phrase, tinyId) of the windows, whose union the phrase takes.
    """
    t = F.split("kmer", " ")
    rows = written(kmers.select(F.col("count").alias("bin"), F.col("kmer").alias("phrase"), F.size(t).alias("k"), F.array_join(F.slice(t, 1, F.size(t) - 1), " ").alias("head"), F.array_join(F.slice(t, 2, F.size(t) - 1), " ").alias("tail")).distinct(), "kmers")
    node = F.concat_ws("\u0001", F.col("bin").cast("string"), "phrase").alias("node")
    key = lambda c: F.concat_ws("\u0001", F.col("bin").cast("string"), F.col("k").cast("string"), c).alias("key")
    some = rows.where("k > 1")
    links = written(_joined(some.select(node, key("tail")), some.select(node, key("head"))).withColumn("overlap", F.size(F.split("right", " ")) - 1), "joints")
    return prune_contained(_spelled(rows.select("bin", "phrase"), links, ids))


def merge_overlapping(phrases: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(phrase, k, count, [n_ids]): phrases (phrase, count) of one count joined where an end of one begins another, widest overlaps first.

    From the widest overlap down every free end takes a free beginning with the same words; ends and beginnings are used
    once, so one pass over the overlaps that occur leaves nothing to join. Rings stay apart.
    """
    rows = written(phrases.select(F.col("count").alias("bin"), "phrase", F.split("phrase", " ").alias("t")).distinct(), "phrases")
    node = F.concat_ws("\u0001", F.col("bin").cast("string"), "phrase").alias("node")
    part = lambda at: F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda n: F.struct(n.alias("n"), F.xxhash64("bin", F.array_join(at(n), " ")).alias("h"), F.concat_ws("\u0001", F.col("bin").cast("string"), F.array_join(at(n), " ")).alias("key")))
    some = rows.where(F.size("t") > 1)
    lefts = written(some.select(node, F.explode(part(lambda n: F.slice("t", -n, n))).alias("p")).select("node", "p.n", "p.key"), "ends")
    rights = written(some.select(node, F.explode(part(lambda n: F.slice("t", F.lit(1), n))).alias("p")).select("node", "p.n", "p.key"), "beginnings")
    meets = lefts.select("n", "key").distinct().join(rights.select("n", "key").distinct(), ["n", "key"])
    links = None
    for n in [r.n for r in meets.select("n").distinct().orderBy(F.desc("n")).collect()]:  # one row a length
        a, b = lefts.where(F.col("n") == n), rights.where(F.col("n") == n)
        if links is not None:
            a, b = a.join(links.select(F.col("left").alias("node")), "node", "left_anti"), b.join(links.select(F.col("right").alias("node")), "node", "left_anti")
        new = written(_joined(a, b).withColumn("overlap", F.lit(n)), "joints")
        links = new if links is None else links.unionByName(new)
    if links is None:
        links = rows.sparkSession.createDataFrame([], "left string, right string, overlap int")
    discard(lefts, rights)
    return _spelled(rows.select("bin", "phrase"), links, ids)


def contigs(kmers: DataFrame) -> DataFrame:
    """(phrase, k, freq): windows (kmer, freq) merged along unbranched overlaps of k-1 tokens; freq is the least of the parts.

    Two windows link if one's tail is the other's head and neither side branches. Chains are contracted by
    pointer doubling over the links, so rounds grow with the logarithm of the longest chain.
    """
    t = F.split("kmer", " ")
    rows = kmers.select("kmer", "freq", F.array_join(F.slice(t, 1, F.size(t) - 1), " ").alias("head"), F.array_join(F.slice(t, 2, F.size(t) - 1), " ").alias("tail"))
    outs = rows.groupBy("head").agg(F.count("*").alias("n_out"))
    ins = rows.groupBy("tail").agg(F.count("*").alias("n_in"))
    single = outs.join(ins, outs["head"] == ins["tail"]).where("n_out = 1 and n_in = 1").select(outs["head"].alias("node"))
    a, b = rows.select(F.col("kmer").alias("left"), F.col("tail").alias("node")), rows.select(F.col("kmer").alias("right"), F.col("head").alias("node"))
    links = written(a.join(single, "node").join(b, "node").where("left <> right").select("left", "right"), "links")
    jump = chains(rows.select(F.col("kmer").alias("node")), links).withColumnRenamed("node", "kmer")
    # members of a closed ring have no head; they stay as windows
    headless = jump.where("root is null").select("kmer")
    last = F.element_at(F.split("kmer", " "), -1)
    chain = jump.join(headless, "kmer", "left_anti").join(kmers.select("kmer", "freq"), "kmer")
    body = chain.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("dist", last.alias("w")))).alias("c"), F.min("freq").alias("freq"))
    phrase = F.concat_ws(" ", F.col("root"), F.array_join(F.transform(F.filter("c", lambda x: x["dist"] > 0), lambda x: x["w"]), " "))
    merged = body.select(F.trim(phrase).alias("phrase"), "freq")
    ring = kmers.join(headless, "kmer", "left_semi").select(F.col("kmer").alias("phrase"), "freq")
    return merged.unionByName(ring).select("phrase", F.size(F.split("phrase", " ")).alias("k"), "freq")


def right_extension(texts: DataFrame, phrases: DataFrame, share: float = 0.5, least_ids: int = 20, most_words: int = 15, key: str = "tinyId") -> DataFrame:
    """(phrase, extended, n_hits, n_ids): the widest continuation that ``share`` of a phrase's hits agree on, with ``least_ids`` records.

    phrases: kmer (lower-case tokens). Continuations of every width are counted by (phrase, width, words);
    a width counts if its most common words reach the share of the hits, and the widest such one wins. A
    residual pass repeats the rule on the hits that do not take the winner.
    """
    from textlens.operators.mining import sequences

    seqs = sequences(texts, key).select(key, "field_path", "tokens")
    sizes = [r.n for r in phrases.select(F.size(F.split("kmer", " ")).alias("n")).distinct().collect()]
    hits = None
    for k in sizes:
        at = F.when(F.size("tokens") >= k, F.transform(F.sequence(F.lit(0), F.size("tokens") - k), lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("tokens", i + 1, k), " ").alias("kmer"))))
        h = seqs.select(key, "field_path", "tokens", F.explode(at).alias("w")).join(phrases.select("kmer"), F.col("w.kmer") == F.col("kmer")).select("kmer", key, "field_path", "w.pos", F.slice("tokens", F.col("w.pos") + k + 1, most_words).alias("next"))
        hits = h if hits is None else hits.unionByName(h)
    if hits is None:
        return texts.sparkSession.createDataFrame([], "phrase string, extended string, n_hits bigint, n_ids bigint")
    live, out = written(hits, "hits"), None
    while True:  # a pass takes at least the share of each phrase's hits, so it ends
        total = live.groupBy("kmer").agg(F.count("*").alias("total"))
        wide = live.where(F.size("next") > 0).select("kmer", key, F.explode(F.transform(F.sequence(F.lit(1), F.size("next")), lambda n: F.struct(n.alias("n"), F.array_join(F.slice("next", 1, n), " ").alias("w")))).alias("x"))
        n = wide.groupBy("kmer", "x.n", "x.w").agg(F.count("*").alias("n_hits"), F.countDistinct(key).alias("n_ids"))
        good = n.join(total, "kmer").where((F.col("n_hits") >= share * F.col("total")) & (F.col("n_ids") >= least_ids))
        best = written(good.groupBy("kmer").agg(F.max(F.struct("n", F.col("n_hits"), F.col("w"), F.col("n_ids"))).alias("b")), "extensions")
        if best.isEmpty():
            break
        rows = best.select(F.col("kmer").alias("phrase"), F.concat_ws(" ", "kmer", "b.w").alias("extended"), "b.n_hits", "b.n_ids")
        out = rows if out is None else out.unionByName(rows)
        taken = live.join(best, "kmer")
        live = written(taken.where(F.array_join(F.slice("next", 1, F.col("b.n")), " ") != F.col("b.w")).select(*live.columns), "hits")
    if out is None:
        return texts.sparkSession.createDataFrame([], "phrase string, extended string, n_hits bigint, n_ids bigint")
    first = out.groupBy("extended").agg(F.min(F.struct((-F.col("n_hits")).alias("m"), "phrase", "n_hits", "n_ids")).alias("f"))
    return first.select("f.phrase", "extended", "f.n_hits", "f.n_ids")


def semantic_groups(names: DataFrame, least: int = 2) -> DataFrame:
    """(name, group_label, frame, generated): prefix groups with a label for frames of time above them, and rows that are implied.

    Names with a frame of time (in the past .., since ..) are grouped by their normal form, so that ``past week`` and
    ``last 1 week`` meet; for each ``in the past 1 unit`` also the form without the number is given, unless it is there.
    """
    base = names.select("name").where("name is not null").distinct()
    framed = base.withColumn("frame", temporal_class(F.col("name"))).withColumn("normal", temporal_normal(F.col("name")))
    labels = prefix_groups(base, least)
    rows = framed.join(labels, "name").select("name", F.when(F.col("frame") == "none", F.col("group_label")).otherwise(F.concat(F.lit("time: "), "normal")).alias("group_label"), "frame", F.lit(False).alias("generated"))
    implied = framed.where(F.col("normal").rlike(r"\bin the past 1 (?:hour|day|week|month|year)\b")).select(F.regexp_replace("normal", r"\bin the past 1 ", "in the past ").alias("name"), F.concat(F.lit("time: "), "normal").alias("group_label"), "frame").distinct()
    new = implied.join(base.select(F.lower("name").alias("name")).distinct(), "name", "left_anti").withColumn("generated", F.lit(True))
    return rows.unionByName(new.select("name", "group_label", "frame", "generated"))
