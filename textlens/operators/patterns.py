"""Pattern algebra: flexible regexes, anchors, variants, merging and coalescing of pattern lists.

Pattern lists are metadata (thousands of rows). Generators are plain functions that make small
DataFrames; everything that meets record ids stays a join on a long table (pattern, tinyId).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlens.operators.matching import containment
from textlens.session import discard, written

# Lead-ins that name an instrument, and words a flexible pattern may lack (fixed values).
ANCHORS = ("as a part of", "a field of", "as part of", "related to", "based on", "field of", "from")
ARTICLES, OPTIONAL = ("the", "a", "an"), ("to", "for", "in", "on", "with", "by", "at")
NUMBERS = {"1": "one", "2": "two", "3": "three", "4": "four", "5": "five", "6": "six", "7": "seven", "8": "eight", "9": "nine", "10": "ten", "12": "twelve", "14": "fourteen", "24": "twenty-four", "30": "thirty"}


def split_anchor(pattern: str) -> tuple[str | None, str]:
    """(anchor, rest): a leading anchor phrase, longest first, as written."""
    for a in ANCHORS:
        if pattern.lower().startswith(a) and (len(pattern) == len(a) or pattern[len(a)].isspace()):
            return pattern[: len(a)], pattern[len(a) :].lstrip()
    return None, pattern


def split_anchor_column(c: Column) -> Column:
    """The pattern without its anchor, as an expression."""
    return F.regexp_replace(c, r"(?i)^(?:" + "|".join(ANCHORS) + r")(?:\s+|$)", "")


def flexible_regex(pattern: str, acronym_variants: bool = False) -> str:
    """A case-insensitive regex for the pattern's usual spellings.

    White space is free; articles and little prepositions may lack, hyphens may be blanks or nothing;
    a version 2 is 2, 2.0, 2.00; with acronym_variants (ABC) also stands for (ABC-1). Boundaries guard
    both ends. Java and Python read it alike.
    """
    anchor, rest = split_anchor(pattern)
    out = [r"\b"] if (anchor or rest)[:1].isalnum() else []
    if anchor:
        out += [r"\s+".join(map(re.escape, anchor.split())), r"\s+" if rest else ""]
    glue, version = "", False
    for token in re.findall(r"\([^)]+\)|\S+", rest):
        low = token.lower()
        if token[0] == "(" and token[-1] == ")":
            inner = token[1:-1]
            m = re.fullmatch(r"([A-Z]+)(?:-\d+)?", inner)
            out += [r"\s*" if glue else "", r"\(" + (re.escape(m[1]) + r"(?:-\d+)?" if acronym_variants and m else re.escape(inner)) + r"\)"]
            glue = r"\s+"
        elif low in ARTICLES or low in OPTIONAL:
            out.append(glue + rf"(?:{re.escape(token)}\s+)?")
            glue = ""
        else:
            n = re.fullmatch(r"(\d+)(?:\.(\d+))?", token)
            if version and n and (n[2] is None or not n[2].strip("0")):
                body = n[1] + r"(?:\.0+)?"
            else:
                body = r"[-\s]?".join(map(re.escape, token.split("-")))
            out += [glue, body]
            glue = r"\s+"
        version = low in ("version", "ver", "v")
    return "".join(out) + r"(?=[\s.,;:!?\"'()\[\]]|$)"


def case_variants(p: str) -> set[str]:
    return {p, p.lower(), p.upper(), p.capitalize(), p.title()}


def plural_variants(p: str) -> set[str]:
    words = p.split(" ")
    last = words[-1]
    other = last[:-1] if last.endswith("s") and not last.endswith("ss") else last + ("es" if re.search(r"(s|x|ch|sh)$", last) else "s")
    return {p, " ".join([*words[:-1], other])}


def number_variants(p: str) -> set[str]:
    words = {v: k for k, v in NUMBERS.items()}
    out = {p}
    for m in re.finditer(r"\b(\d+|[a-z]+(?:-four)?)\b", p):
        if other := NUMBERS.get(m[1]) or words.get(m[1]):
            out.add(p[: m.start()] + other + p[m.end() :])
    return out


def temporal_variants(p: str) -> set[str]:
    """past / last / previous and the prepositions before them."""
    m = re.match(r"(?i)^(in|over|during|within) the (past|last|previous) (.+)$", p)
    if not m:
        return {p}
    return {f"{a} the {b} {m[3]}" for a in ("in", "over", "during", "within") for b in ("past", "last", "previous")} | {p}


def punctuation_variants(p: str) -> set[str]:
    base = p.rstrip(".,;: -")
    return {p, base, *(base + s for s in (".", ",", ";", ":", " - "))}


def spacing_variants(p: str) -> set[str]:
    return {p, p.replace("-", " "), p.replace("-", ""), re.sub(r"\s+", " ", p)}


GENERATORS = {"case": case_variants, "plural": plural_variants, "number": number_variants, "temporal": temporal_variants, "punctuation": punctuation_variants, "spacing": spacing_variants}


def expand(spark: SparkSession, patterns: list[str], kinds: list[str]) -> DataFrame:
    """(pattern, variant): the patterns through the named generators one after the other."""
    rows = []
    for p in patterns:
        now = {p}
        for kind in kinds:
            now = set().union(*(GENERATORS[kind](x) for x in now))
        rows += [(p, v) for v in sorted(now)]
    return spark.createDataFrame(rows, "pattern string, variant string")


def with_anchors(patterns: DataFrame) -> DataFrame:
    """(pattern, anchored): each bare pattern after each anchor, with and without article."""
    anchors = F.explode(F.array(*[F.lit(a + s) for a in ANCHORS for s in (" ", " the ")]))
    return patterns.select("pattern", anchors.alias("a")).select("pattern", F.concat("a", split_anchor_column(F.col("pattern"))).alias("anchored")).distinct()


def merge_duplicates(ids: DataFrame) -> DataFrame:
    """(pattern, n_ids): rows of one pattern as one, record ids united; ids: (pattern, tinyId)."""
    return ids.distinct().groupBy("pattern").agg(F.count("tinyId").alias("n_ids"))


def merge_lists(first: DataFrame, second: DataFrame) -> DataFrame:
    """(pattern, replace_with, universal): the later list's replacement wins; a universal pattern stays universal."""
    rows = first.withColumn("list_ord", F.lit(1)).unionByName(second.withColumn("list_ord", F.lit(2)))
    return rows.groupBy("pattern").agg(F.max(F.struct("list_ord", "replace_with")).alias("m"), F.max("universal").alias("universal")).select("pattern", "m.replace_with", "universal")


_ALL = "\u0000all"  # the id that stands for every record: a universal pattern is only within a universal one
CONNECTORS = "of for and the a an in on to with by or at from as -".split()


def bare_column(c: Column) -> Column:
    """The name behind an anchor, leading or further inside, without version and article; the pattern itself if none is left."""
    behind = F.regexp_replace(c, r"(?is)^(?:.*?\b)?(?:" + "|".join(ANCHORS) + r")\s+(?:version\s+[\d.]+\s+of\s+)?(?:(?:" + "|".join(ARTICLES) + r")\s+)?(?=\S)", "")
    return F.trim(behind)


def core_column(c: Column) -> Column:
    """struct<core, acronym>: a bare name without its trailing acronym in brackets."""
    acronym = F.nullif(F.regexp_extract(c, r"^.+?\s*\(([^)]+)\)$", 1), F.lit(""))
    return F.struct(F.coalesce(F.nullif(F.regexp_extract(c, r"^(.+?)\s*\([^)]+\)$", 1), F.lit("")), c).alias("core"), acronym.alias("acronym"))


def core_regex(bare: str) -> str:
    """A regex of a core name with any version and any acronym of the same letters behind it; boundaries as in ``flexible_regex``."""
    m = re.match(r"^(.+?)\s*\(([^)]+)\)$", bare)
    core, acronym = (m[1].strip(), m[2]) if m else (bare, None)
    end = r"(?=[\s.,;:!?\"'()\[\]]|$)"
    letters = re.match("[A-Za-z]+", acronym or "")
    bracket = rf"{re.escape(letters[0])}[-\s]?[^)]*" if letters else r"[^)]+"
    return flexible_regex(core).removesuffix(end) + rf"(?:\s+(?:version|ver|v)\.?\s*\d+(?:\.\d+)?)?(?:\s*\({bracket}\))?" + end


def names_on(extension: Column) -> Column:
    """Whether what follows a base goes on naming: four of five words capitalised, numbers or connectors, one of them capitalised."""
    clean = lambda w: F.regexp_replace(w, r"[.,;:!?]+$", "")
    words = F.filter(F.split(F.regexp_replace(F.trim(extension), r"^[ ,;:\-]+|[ ,;:\-]+$", ""), r"\s+"), lambda w: w != "")
    fits = F.filter(words, lambda w: clean(w).rlike(r"^(?:\p{Lu}|\d)|-\p{Lu}") | F.lower(clean(w)).isin(*CONNECTORS))
    named = F.exists(words, lambda w: clean(w).rlike(r"^\p{Lu}"))
    return ~F.trim(extension).rlike(r"^[(,;]") & (F.size(words) > 0) & (F.size(fits) >= 0.8 * F.size(words)) & named


_BRACKETED = r"\(\p{Lu}[A-Za-z0-9-]+\)"


def _subsumed(sizes: DataFrame, held: DataFrame, pairs: DataFrame) -> DataFrame:
    """(out, by, prefix): patterns whose kept containers hold all their records together; prefix: one of them begins with it.

    A round decides every pattern whose containers are all decided, so rounds grow with the depth of containment.
    """
    undecided = written(sizes.select("pattern"), "undecided")
    gone = written(sizes.select(F.col("pattern").alias("out"), F.col("pattern").alias("by"), F.lit(False).alias("prefix")).limit(0), "subsumed")
    while True:
        waits = pairs.join(undecided.withColumnRenamed("pattern", "long"), "long", "left_semi").select(F.col("short").alias("pattern")).distinct()
        ready = written(undecided.join(waits, "pattern", "left_anti"), "ready")
        if ready.isEmpty():
            discard(ready, undecided)
            return gone
        dropped = gone.where("not prefix").select(F.col("out").alias("long"))
        level = pairs.join(ready.withColumnRenamed("pattern", "short"), "short", "left_semi").join(dropped, "long", "left_anti")
        covers = level.join(held.withColumnRenamed("pattern", "long"), "long").select("short", "id").distinct()
        own = level.select(F.col("short").alias("pattern")).distinct().join(held, "pattern")
        open_ = own.join(covers, (own.pattern == covers.short) & (own.id == covers.id), "left_anti").select(own.pattern.alias("short")).distinct()
        shut = level.join(open_, "short", "left_anti").groupBy("short").agg(F.max(F.struct(F.length("long").alias("n"), "long")).alias("b"), F.max("prefix").alias("prefix"))
        grown = written(gone.unionByName(shut.select(F.col("short").alias("out"), F.col("b.long").alias("by"), "prefix")), "subsumed")
        rest = written(undecided.join(ready, "pattern", "left_anti"), "undecided")
        discard(gone, undecided, ready)
        gone, undecided = grown, rest


def _within(pairs: DataFrame, held: DataFrame, inner: str, outer: str) -> DataFrame:
    """The pairs of which ``outer`` holds every record of ``inner``."""
    n = held.groupBy("pattern").agg(F.count("*").alias("n_inner")).withColumnRenamed("pattern", inner)
    shared = pairs.select(inner, outer).join(held.withColumnRenamed("pattern", inner), inner).join(held.withColumnRenamed("pattern", outer), [outer, "id"]).groupBy(inner, outer).agg(F.count("*").alias("both"))
    return pairs.join(shared, [inner, outer]).join(n, inner).where("both = n_inner").select(*pairs.columns)


def coalesce(ids: DataFrame, parents: DataFrame | None = None, least_parent_ids: int = 0, least_actual_ids: int = 0, defer: bool = False, roll: bool = False, least_prefix_ids: int = 0, definition_forms: bool = False) -> DataFrame:
    """(pattern, group_key, n_ids, status, replacement): a pattern list brought down to the patterns it needs.

    ids: (pattern, tinyId), a null id means every record. parents: (pattern, parent_phrase, parent_tinyid_count).
    In this order:

    * anchors are trimmed, also inside a pattern, and id sets united;
    * ``parent-filtered``: parents with too few records (not if the pattern itself has ``least_actual_ids``), at once or,
      with ``defer``, only if no prefix took the pattern over;
    * ``subsumed``: kept longer patterns contain it and hold all its records together; if one of them begins with it,
      it stays (``prefix-kept`` in the report), for it still strips shorter texts;
    * with ``roll``, ``rolled-down``: a base of two words or more inside it holds all its records, unless it adds an acronym in
      brackets or goes on naming; then ``rolled-up``: a pattern of more words contains it and holds all its records;
    * with ``least_prefix_ids``, ``prefix``: the longest prefix that covers two patterns or more with so many records replaces
      them (ties: records, then name), unless an acronym in brackets would be lost;
    * with ``definition_forms`` a pattern that ends in a dash also gives the form without it.

    The group key is the longest word prefix shared with another kept pattern, at least two words, else the first two.
    """
    trimmed = ids.select(bare_column(F.col("pattern")).alias("pattern"), F.coalesce("tinyId", F.lit(_ALL)).alias("id")).where("pattern <> ''").distinct()
    held = written(trimmed, "trimmed")
    count = F.count(F.when(F.col("id") != _ALL, 1))
    sizes = written(held.groupBy("pattern").agg(count.alias("n_ids")), "sizes")
    status = lambda df, s, by: df.select("pattern", F.lit(s).alias("status"), by.alias("replacement"))
    weak = sizes.select("pattern").limit(0)
    if least_parent_ids and parents is not None:
        p = parents.select(bare_column(F.col("pattern")).alias("pattern"), "parent_tinyid_count").groupBy("pattern").agg(F.max("parent_tinyid_count").alias("p"))
        low = F.coalesce("p", F.lit(0)) < least_parent_ids
        rescued = (F.col("n_ids") >= least_actual_ids) if least_actual_ids else F.lit(False)
        weak = written(sizes.join(p, "pattern", "left").where(low & ~rescued).select("pattern"), "weak")
    live = sizes if defer else sizes.join(weak, "pattern", "left_anti")
    pairs = containment(live.select("pattern", F.length("pattern").alias("ord"))).where(F.contains("long", F.col("short"))).select("short", "long", F.startswith("long", F.col("short")).alias("prefix"))
    pairs = written(pairs, "contains")
    gone = _subsumed(live, held, pairs)
    fates = status(gone.where("not prefix").withColumnRenamed("out", "pattern"), "subsumed", F.col("by"))
    keep = written(live.join(gone.where("not prefix").select(F.col("out").alias("pattern")), "pattern", "left_anti").select("pattern"), "kept")

    def both_kept():
        return pairs.join(keep.withColumnRenamed("pattern", "short"), "short", "left_semi").join(keep.withColumnRenamed("pattern", "long"), "long", "left_semi")

    words = lambda c: F.size(F.split(F.trim(c), r"\s+"))
    if roll:
        acronym = F.regexp_extract("long", _BRACKETED, 0)
        on = F.col("prefix") & names_on(F.substring("long", F.length("short") + 1, F.length("long")))
        down = both_kept().where((words("short") >= 2) & ((acronym == "") | F.contains("short", acronym)) & ~on)
        if defer:
            down = down.join(weak.withColumnRenamed("pattern", "long"), "long", "left_anti")
        down = _within(down, held, "long", "short").groupBy(F.col("long").alias("pattern")).agg(F.max(F.struct(F.length("short").alias("n"), "short")).alias("b"))
        down = written(status(down, "rolled-down", F.col("b.short")), "rolled")
        keep = written(keep.join(down, "pattern", "left_anti"), "kept")
        up = _within(both_kept().where(words("long") > words("short")), held, "short", "long").groupBy(F.col("short").alias("pattern")).agg(F.min(F.struct((-words("long")).alias("n"), "long")).alias("b"))
        up = written(status(up, "rolled-up", F.col("b.long")), "rolled")
        keep = written(keep.join(up, "pattern", "left_anti"), "kept")
        fates = fates.unionByName(down).unionByName(up)
    if least_prefix_ids:
        t = F.transform(F.split(F.trim("pattern"), r"\s+"), lambda w: F.coalesce(F.nullif(F.regexp_replace(w, r"[.,;:!?]", ""), F.lit("")), w))
        heads = keep.where(F.size(t) >= 2).select(F.col("pattern").alias("member"), F.explode(F.transform(F.sequence(F.lit(2), F.size(t)), lambda n: F.struct(n.alias("k"), F.array_join(F.slice(t, 1, n), " ").alias("group")))).alias("g")).select("g.group", "g.k", "member")
        bracket = F.regexp_extract("member", _BRACKETED, 0)
        members = held.withColumnRenamed("pattern", "member")
        reach = heads.join(members, "member").groupBy("group").agg(F.countDistinct("id").alias("weight")).where(F.col("weight") >= least_prefix_ids)
        cover = greedy_members(heads.join(reach, "group").withColumn("guarded", (bracket != "") & ~F.contains("group", bracket)), 2, members, least_prefix_ids)
        cover = written(cover, "prefixes")
        fates = fates.unionByName(status(cover.withColumnRenamed("member", "pattern"), "prefix", F.col("group")))
        held = written(held.join(cover.select(F.col("member").alias("pattern")), "pattern", "left_anti").unionByName(members.join(cover, "member").select(F.col("group").alias("pattern"), "id")).distinct(), "held")
        taken = cover.select(F.col("member").alias("pattern")).distinct()
        keep = keep.join(taken, "pattern", "left_anti").unionByName(cover.select(F.col("group").alias("pattern"))).distinct()
        if defer:
            late = weak.join(taken, "pattern", "left_anti")
            fates = fates.unionByName(status(late.join(fates.select("pattern"), "pattern", "left_anti"), "parent-filtered", F.lit(None).cast("string")))
            keep = keep.join(late, "pattern", "left_anti")
        keep = written(keep, "kept")
    elif defer:
        fates = fates.unionByName(status(weak.join(fates.select("pattern"), "pattern", "left_anti"), "parent-filtered", F.lit(None).cast("string")))
        keep = written(keep.join(weak, "pattern", "left_anti"), "kept")
    if not defer:
        fates = fates.unionByName(status(weak, "parent-filtered", F.lit(None).cast("string")))
    if definition_forms:
        bare = keep.select("pattern", F.regexp_replace("pattern", r"\s+-\s*$", "").alias("form")).where("form <> pattern and form <> ''")
        new = bare.join(keep.select(F.col("pattern").alias("form")), "form", "left_anti")
        held = held.unionByName(held.join(new, "pattern").select(F.col("form").alias("pattern"), "id")).distinct()
        keep = keep.unionByName(new.select(F.col("form").alias("pattern"))).distinct()
    n = held.groupBy("pattern").agg(count.alias("n_ids"))
    kept = keep.join(n, "pattern", "left").select("pattern", F.coalesce("n_ids", F.lit(0)).alias("n_ids"), F.lit("kept").alias("status"), F.lit(None).cast("string").alias("replacement"))
    lost = fates.join(keep, "pattern", "left_anti").join(sizes, "pattern", "left").select("pattern", "n_ids", "status", "replacement")
    return group_keys(kept.unionByName(lost))


def group_keys(rows: DataFrame) -> DataFrame:
    """rows (pattern, n_ids, status, replacement) with ``group_key``; only kept patterns share prefixes."""
    t = F.split(F.trim("pattern"), r"\s+")
    plain = F.transform(t, lambda w: F.regexp_replace(w, r"[.,;:!?'\")}\]]", ""))
    heads = rows.where("status = 'kept'").where(F.size(t) >= 2).select("pattern", F.explode(F.transform(F.sequence(F.lit(2), F.size(t)), lambda n: F.struct(n.alias("k"), F.array_join(F.slice(plain, 1, n), " ").alias("head")))).alias("h")).select("pattern", "h.*")
    shared = heads.groupBy("head", "k").agg(F.count("*").alias("n")).where("n > 1").select("head")
    best = heads.join(shared, "head").groupBy("pattern").agg(F.max("k").alias("k"))
    key = F.array_join(F.slice(t, 1, F.coalesce("k", F.lit(2))), " ")
    return rows.join(best, "pattern", "left").select("pattern", key.alias("group_key"), "n_ids", "status", "replacement")


def greedy_members(groups: DataFrame, least_new: int = 2, ids: DataFrame | None = None, least_ids: int = 0) -> DataFrame:
    """(group, member): which group takes each member: longest first, then by weight, then by name; a group must take ``least_new``.

    groups: (group, k, weight, member) and, if wanted, guarded: a group with a guarded member still open is passed over.
    ids: (member, id), with ``least_ids`` the open members of a group must have so many together. A round decides at once every
    group that no better group with a common open member precedes; the result equals the sequential rule.
    """
    guarded = F.col("guarded") if "guarded" in groups.columns else F.lit(False)
    live = written(groups.select("group", F.struct((-F.col("k")).alias("k"), (-F.col("weight")).alias("w"), "group").alias("rank"), "member", guarded.alias("guarded")).distinct(), "groups")
    taken = None
    while True:
        enough = live.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") >= least_new).select("group")
        open_ = live.join(enough, "group")
        best = open_.groupBy("member").agg(F.min("rank").alias("best"))
        blocked = open_.join(best, "member").where(F.col("rank") != F.col("best")).select("group").distinct()
        turn = written(open_.join(blocked, "group", "left_anti"), "turn")
        if turn.isEmpty():
            discard(turn, live)
            return taken if taken is not None else groups.select("group", "member").limit(0)
        passed = turn.groupBy("group").agg(F.max("guarded").alias("g")).where("not g").select("group")
        if ids is not None and least_ids:
            passed = passed.join(turn.join(ids, "member").groupBy("group").agg(F.countDistinct("id").alias("n")).where(F.col("n") >= least_ids), "group", "left_semi")
        won = written(turn.join(passed, "group", "left_semi").select("group", "member"), "won")
        taken = won if taken is None else taken.unionByName(won)
        rest = open_.join(turn.select("group").distinct(), "group", "left_anti").join(won.select("member").distinct(), "member", "left_anti")
        after = written(rest.select("group", "rank", "member", "guarded"), "groups")
        discard(turn, live)
        live = after


def greedy_cover(groups: DataFrame, least_new: int = 2, long_from: int | None = None) -> DataFrame:
    """(group, k, n_new): groups kept by greedy cover: longest first, then most members, then by name; each covers ``least_new`` new ones.

    groups: (group, k, member). With ``long_from`` groups of that length or more which have ``least_new`` members stay even
    if others cover them (n_new 0); they cover nothing themselves.
    """
    rows = groups.select("group", "k", "member").distinct()
    size = rows.groupBy("group", "k").agg(F.count("*").alias("weight"))
    rows = written(rows.join(size, ["group", "k"]), "groups")
    new = greedy_members(rows, least_new).groupBy("group").agg(F.count("*").alias("n_new"))
    every = rows.select("group", "k", "weight").distinct().join(new, "group", "left")
    stays = F.col("n_new").isNotNull() if long_from is None else F.col("n_new").isNotNull() | ((F.col("weight") >= least_new) & (F.col("k") >= long_from))
    return every.where(stays).select("group", "k", F.coalesce("n_new", F.lit(0)).alias("n_new"))


def tiers(kept: DataFrame, words: int = 3) -> DataFrame:
    """kept patterns with ``tier``: long ones (of ``words`` words or more) strip safely, short ones want review."""
    return kept.withColumn("tier", F.when(F.size(F.split(F.trim("pattern"), r"\s+")) >= words, "long").otherwise("short"))


def cross_acronyms(patterns: DataFrame) -> DataFrame:
    """(pattern, variant): every name with each acronym that any pattern of the same name has, in brackets and with a dash.

    Acronyms of a name meet by an equi-join on the name without acronym, case aside.
    """
    core = core_column(F.col("pattern"))
    rows = patterns.select("pattern", core.alias("c")).select("pattern", F.col("c.core").alias("core"), F.lower("c.core").alias("k"), F.col("c.acronym").alias("acronym"))
    acronyms = rows.where("acronym is not null").select("k", F.col("acronym").alias("a")).distinct()
    forms = F.array(F.concat("core", F.lit(" ("), "a", F.lit(")")), F.concat("core", F.lit(" ("), "a", F.lit(") -")), F.concat("a", F.lit(" - "), "core"))
    return rows.join(acronyms, "k").select("pattern", F.explode(forms).alias("variant")).where("variant <> pattern").distinct()
