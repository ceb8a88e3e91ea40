"""Patterns against texts: occurrences, distributions, containment, recall, leakage.

A pattern list goes to the workers in parts of about ``MOST_PATTERNS`` rows, each of which becomes one Aho-Corasick
automaton for each task: texts are read once a part, nothing is shuffled, no text meets a pattern that does not stand
in it, and time is linear in the text however many patterns there are. Lists of any length give the same rows in one part
or in many. Patterns with a scope join on the record. Patterns in patterns (containment) are found alike.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textlens.session import written

MOST_PATTERNS = 100_000


def parts(patterns: DataFrame, most: int = MOST_PATTERNS) -> list[list[str]]:
    """The distinct patterns (column pattern, not blank) in parts of about ``most``, by hash; each part is collected by itself."""
    pats = patterns.select("pattern").where("pattern is not null and pattern <> ''").distinct()
    head = [r.pattern for r in pats.limit(most + 1).collect()]
    if len(head) <= most:
        return [head]
    pats = written(pats, "patterns")
    n = -(-pats.count() // most)
    return [[r.pattern for r in pats.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i).collect()] for i in range(n)]


def literal_hits(texts: DataFrame, patterns: DataFrame, ignore_case: bool = True, key: str = "tinyId", most: int = MOST_PATTERNS) -> DataFrame:
    """(pattern, key, field, field_path, text): texts that contain a pattern; patterns: column pattern."""
    out = None
    for part in parts(patterns, most):
        rows = texts.select(key, "field", "field_path", "text").withColumn("_p", _found(texts, part, ignore_case)).where(F.size("_p") > 0)
        rows = rows.select(F.explode("_p").alias("pattern"), key, "field", "field_path", "text")
        out = rows if out is None else out.unionByName(rows)
    return out


def _found(texts: DataFrame, part: list[str], ignore_case: bool) -> Column:
    shared, kept = texts.sparkSession.sparkContext.broadcast(part), {}

    @F.pandas_udf("array<string>")
    def found(s: pd.Series) -> pd.Series:
        if "a" not in kept:  # once for each task
            a = ahocorasick.Automaton()
            for p in shared.value:
                k = p.lower() if ignore_case else p
                a.add_word(k, (*a.get(k, ()), p))
            if len(a):
                a.make_automaton()
            kept["a"] = a
        a = kept["a"]
        if not len(a):
            return pd.Series([[]] * len(s))
        return s.map(lambda t: [] if not t else sorted({p for _, ps in a.iter(t.lower() if ignore_case else t) for p in ps}))

    return found("text")


def scoped_hits(texts: DataFrame, scopes: DataFrame, key: str = "tinyId") -> DataFrame:
    """Hits of patterns in their own records only; scopes: (pattern, key)."""
    return texts.join(scopes, key).where(F.contains(F.lower("text"), F.lower("pattern"))).select("pattern", key, "field", "field_path", "text")


def field_distribution(hits: DataFrame, key: str = "tinyId") -> DataFrame:
    """(pattern, n_definition, n_designation, n_other, n_ids): distinct records by field."""
    per = hits.groupBy("pattern", key).agg(*[F.max((F.col("field") == f).cast("int")).alias(f) for f in ("definition", "designation")], F.max((~F.col("field").isin("definition", "designation")).cast("int")).alias("other"))
    return per.groupBy("pattern").agg(F.sum("definition").alias("n_definition"), F.sum("designation").alias("n_designation"), F.sum("other").alias("n_other"), F.count("*").alias("n_ids"), F.sum(F.col("definition") * F.col("designation")).alias("n_both"))


def field_profile(distribution: DataFrame) -> DataFrame:
    """profile: def-only, desig-only, both-all (the same records) or mixed, by sets and not by counts."""
    d, g, both = F.col("n_definition"), F.col("n_designation"), F.col("n_both")
    kind = F.when((d > 0) & (g == 0), "def-only").when((g > 0) & (d == 0), "desig-only").when((d == both) & (g == both) & (both > 0), "both-all").when(both + d + g > 0, "mixed").otherwise("none")
    return distribution.withColumn("profile", kind)


def inside(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """(short, long): texts (column pattern) of one list that stand in those of the other, case aside; equal ones not."""
    rows = longer.select(F.col("pattern").alias("tinyId"), F.lit("").alias("field"), F.lit("").alias("field_path"), F.lower("pattern").alias("text")).where("text <> ''").distinct()
    small = shorter.select("pattern", F.lower("pattern").alias("l")).where("l <> ''").distinct()
    hits = literal_hits(rows, small.select(F.col("l").alias("pattern")), ignore_case=False)
    pairs = hits.where(F.length("pattern") < F.length("text")).select(F.col("pattern").alias("l"), F.col("tinyId").alias("long"))
    return pairs.join(small, "l").select(F.col("pattern").alias("short"), "long")


def containment(patterns: DataFrame) -> DataFrame:
    """(short, long, relation, conflict): pairs of patterns of which one contains the other.

    relation: prefix, suffix or infix. conflict: the shorter would be stripped first in file order (column ord).
    """
    p = patterns.select("ord", "pattern").where("pattern <> ''")
    pairs = inside(p, p)
    short, long = p.select(F.col("ord").alias("short_ord"), F.col("pattern").alias("short")), p.select(F.col("ord").alias("long_ord"), F.col("pattern").alias("long"))
    kind = F.when(F.startswith(F.lower("long"), F.lower("short")), "prefix").when(F.endswith(F.lower("long"), F.lower("short")), "suffix").otherwise("infix")
    return pairs.join(short, "short").join(long, "long").select("short", "long", kind.alias("relation"), (F.col("short_ord") < F.col("long_ord")).alias("conflict")).distinct()


def validate_subsumption(hits: DataFrame, groups: DataFrame, key: str = "tinyId") -> DataFrame:
    """(group_key, pattern, keep): a pattern stays if some (record, field) it matches is matched by no longer member containing it.

    Hits meet through the pairs of patterns that contain each other, never all members of a group with all.
    """
    own = hits.join(groups, "pattern").select("group_key", "pattern", key, "field_path").distinct()
    members = groups.select("group_key", "pattern").distinct()
    pairs = inside(members, members).withColumnRenamed("short", "pattern").withColumnRenamed("long", "longer")
    longer = own.withColumnRenamed("pattern", "longer")
    covered = own.join(pairs, "pattern").join(longer, ["group_key", "longer", key, "field_path"], "left_semi").select("group_key", "pattern", key, "field_path").distinct()
    free = own.join(covered, ["group_key", "pattern", key, "field_path"], "left_anti").select("group_key", "pattern").distinct()
    return members.join(free.withColumn("keep", F.lit(True)), ["group_key", "pattern"], "left").select("group_key", "pattern", F.coalesce("keep", F.lit(False)).alias("keep"))


def around(hits: DataFrame, most: int = 3) -> DataFrame:
    """(pattern, side, n_words, words, n): up to ``most`` words left and right of every hit (from left to right, without overlap), counted."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(F.lower("pattern"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    parted = hits.select("pattern", F.lower("pattern").alias("l"), F.split(F.lower("text"), quoted, -1).alias("p")).where(F.size("p") > 1)
    at = parted.select("pattern", "l", "p", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("i"))
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    left, right = words(F.array_join(F.slice("p", F.lit(1), F.col("i")), "\u0000").alias("x")), words(F.array_join(F.slice("p", F.col("i") + 1, F.size("p")), "\u0000"))
    sides = F.array(F.struct(F.lit("left").alias("side"), left.alias("w")), F.struct(F.lit("right").alias("side"), right.alias("w")))
    rows = at.select("pattern", "l", F.explode(sides).alias("s")).select("pattern", "s.side", F.filter(F.split(F.replace(F.array_join("s.w", " "), F.lit("\u0000"), F.col("l")), r"\s+"), lambda w: w != "").alias("w"))
    each = rows.where(F.size("w") > 0).select("pattern", "side", "w", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.size("w")))).alias("n_words"))
    said = F.array_join(F.when(F.col("side") == "left", F.slice("w", -F.col("n_words"), F.col("n_words"))).otherwise(F.slice("w", F.lit(1), F.col("n_words"))), " ")
    return each.groupBy("pattern", "side", "n_words", said.alias("words")).agg(F.count("*").alias("n"))


def recall(wanted: DataFrame, captured: DataFrame) -> DataFrame:
    """(label, pattern, n_source, n_captured, n_missing, recall) with totals by label (pattern null); wanted: (label, pattern, tinyId)."""
    flagged = wanted.distinct().join(captured.select("tinyId").distinct().withColumn("got", F.lit(1)), "tinyId", "left")
    per = flagged.groupBy("label", "pattern", "tinyId").agg(F.max(F.coalesce("got", F.lit(0))).alias("got"))
    each = per.groupBy("label", "pattern").agg(F.count("*").alias("n_source"), F.sum("got").alias("n_captured"))
    total = per.groupBy("label", "tinyId").agg(F.max("got").alias("got")).groupBy("label").agg(F.count("*").alias("n_source"), F.sum("got").alias("n_captured")).withColumn("pattern", F.lit(None).cast("string"))
    return each.unionByName(total).select("label", "pattern", "n_source", "n_captured", (F.col("n_source") - F.col("n_captured")).alias("n_missing"), F.format_number(F.col("n_captured") / F.col("n_source"), 3).alias("recall"))


def marginal_gains(now: DataFrame, before: DataFrame) -> DataFrame:
    """(family, n_now, n_before, gain): difference of counts by family; gain counts only increases."""
    a, b = now.select("family", F.col("n").alias("n_now")), before.select("family", F.col("n").alias("n_before"))
    j = a.join(b, "family", "full").select("family", F.coalesce("n_now", F.lit(0)).alias("n_now"), F.coalesce("n_before", F.lit(0)).alias("n_before"))
    return j.withColumn("gain", F.greatest(F.lit(0), F.col("n_now") - F.col("n_before")))


def total_gain(gains: DataFrame) -> DataFrame:
    """One row: n_families, n_grown, total_gain (increases only)."""
    return gains.agg(F.count("*").alias("n_families"), F.count(F.when(F.col("gain") > 0, 1)).alias("n_grown"), F.coalesce(F.sum("gain"), F.lit(0)).alias("total_gain"))


# Frames of time in item texts and usual boilerplate (fixed values).
TEMPORAL = r"\b(?:in|over|during|for|within)\s+the\s+(?:past|last)\s+(?:\d+|[a-z]+)\s+(?:days?|weeks?|months?|years?)"
BOILERPLATE = r"as part of the \w+ battery|based on the \w+|free-text field related to|indicator of whether"
ANCHORS = ("as part of", "as a part of", "based on", "related to")


def leakage(texts: DataFrame, patterns: dict[str, str], key: str = "tinyId") -> DataFrame:
    """(kind, match, n_hits, n_ids): what is left of each kind of phrase, by text found."""
    hits = [texts.select(F.lit(kind).alias("kind"), key, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({p})"), F.lit(1))).alias("match")) for kind, p in patterns.items()]
    rows = hits[0]
    for h in hits[1:]:
        rows = rows.unionByName(h)
    return rows.groupBy("kind", "match").agg(F.count("*").alias("n_hits"), F.countDistinct(key).alias("n_ids"))


def anchor_residue(texts: DataFrame, key: str = "tinyId", chars: int = 100) -> DataFrame:
    """(anchor, context, category, n, n_ids): normalised text after an anchor up to the sentence end."""
    p = "(" + "|".join(ANCHORS) + r")\s+([^.;!?]{1," + str(chars) + "})"
    pairs = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(p), F.lit(0)), lambda m: F.struct(F.regexp_extract(m, p, 1).alias("anchor"), F.trim(F.regexp_replace(F.regexp_extract(m, p, 2), r"\s+", " ")).alias("context")))
    rows = texts.select(key, F.explode(pairs).alias("x")).select(key, "x.*")
    kind = F.when(F.col("context").rlike(r"^(the|a|an)$|^$"), "empty").when(F.col("context").rlike(r"\b(battery|scale|index|inventory|questionnaire|survey|interview|checklist|schedule|form)\b"), "instrument").otherwise("other")
    return rows.groupBy("anchor", "context", kind.alias("category")).agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_ids"))


def rare_words(texts: DataFrame, least_ids: int = 3, most_zipf: float = 3.0, capital_penalty: float = 2.5, key: str = "tinyId") -> DataFrame:
    """(word, n, n_ids, zipf): dominant casing of words whose corpus Zipf score is low.

    zipf = log10(occurrences per thousand million words), all-capital words less the penalty.
    """
    rows = texts.select(key, F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{3,}"), F.lit(0))).alias("w"))
    forms = rows.groupBy(F.lower("w").alias("l"), "w", key).agg(F.count("*").alias("c"))
    by_form = forms.groupBy("l", "w").agg(F.sum("c").alias("c"))
    words = by_form.groupBy("l").agg(F.sum("c").alias("n"), F.min(F.struct((-F.col("c")).alias("m"), "w")).alias("b"))
    ids = forms.groupBy("l").agg(F.countDistinct(key).alias("n_ids"))
    total = by_form.agg(F.sum("c").alias("total"))
    z = F.round(F.log10(F.col("n") / F.col("total") * 1e9) - F.when(F.col("b.w") == F.upper("b.w"), capital_penalty).otherwise(0), 4)
    out = words.join(ids, "l").crossJoin(F.broadcast(total)).select(F.col("b.w").alias("word"), "n", "n_ids", z.alias("zipf"))
    return out.where((F.col("n_ids") >= least_ids) & (F.col("zipf") < most_zipf))


def harvest(residual: DataFrame, patterns: DataFrame) -> DataFrame:
    """(phrase, status, pattern): should_have_matched (contains a pattern), partial_match (inside one), new_candidate; both share a whole word.

    Containment is found by automata in both directions, not by a join on words.
    """
    r, p = residual.select("phrase").distinct(), patterns.select("pattern").distinct()
    asp = r.select(F.col("phrase").alias("pattern"))
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    full = inside(asp, p).select(F.col("long").alias("phrase"), F.col("short").alias("pattern"), F.lit(0).alias("o"))
    part = inside(p, asp).select(F.col("short").alias("phrase"), F.col("long").alias("pattern"), F.lit(1).alias("o"))
    same = r.join(p, F.lower("phrase") == F.lower("pattern")).select("phrase", "pattern", F.lit(0).alias("o"))
    near = full.unionByName(part).unionByName(same).where(F.arrays_overlap(words("phrase"), words("pattern")))
    found = near.groupBy("phrase").agg(F.min(F.struct("o", "pattern")).alias("m"))
    status = F.when(F.col("m").isNull(), "new_candidate").when(F.col("m.o") == 0, "should_have_matched").otherwise("partial_match")
    return r.join(found, "phrase", "left").select("phrase", status.alias("status"), F.col("m.pattern").alias("pattern"))


def prefix_groups(patterns: DataFrame, words: int = 3, least: int = 2) -> DataFrame:
    """(prefix, n_patterns, n_next, divergence): patterns sharing their first words, and how they part."""
    t = F.split(F.lower("pattern"), " ")
    rows = patterns.where(F.size(t) >= words).select("pattern", F.array_join(F.slice(t, 1, words), " ").alias("prefix"), F.coalesce(F.get(t, F.lit(words)), F.lit("")).alias("next"))
    g = rows.groupBy("prefix").agg(F.countDistinct("pattern").alias("n_patterns"), F.countDistinct("next").alias("n_next")).where(F.col("n_patterns") >= least)
    return g.withColumn("divergence", F.round(F.col("n_next") / F.col("n_patterns"), 4))


def anchor_misses(texts: DataFrame, known: DataFrame, key: str = "tinyId", chars: int = 60) -> DataFrame:
    """(anchor, context, n_ids): what follows an anchor in records where none of the known patterns was found (``known``: key)."""
    rest = texts.join(known.select(key).distinct(), key, "left_anti")
    p = r"\b(" + "|".join(ANCHORS) + r")\s+((?:the\s+)?[^.;!?,]{3," + str(chars) + "})"
    m = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(p), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, p, 1).alias("anchor"), F.trim(F.regexp_replace(F.regexp_extract(x, p, 2), r"\s+", " ")).alias("context")))
    return rest.select(key, F.explode(m).alias("m")).groupBy("m.anchor", "m.context").agg(F.countDistinct(key).alias("n_ids"))


def family_misses(wanted: DataFrame, captured: DataFrame) -> DataFrame:
    """(family, n_missed, example): records of each family that were not captured; wanted: (family, tinyId), captured: (tinyId)."""
    missed = wanted.select("family", "tinyId").distinct().join(captured.select("tinyId").distinct(), "tinyId", "left_anti")
    return missed.groupBy("family").agg(F.count("*").alias("n_missed"), F.min("tinyId").alias("example"))
