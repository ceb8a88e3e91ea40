"""Discovery of pattern spellings in texts, masking of known spans, pruning, splits, recall suggestions."""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions import text as tx
from textlens.operators import matching, mining, patterns as pt
from textlens.session import written


def fixed_word(pattern: str) -> str | None:
    """The longest word that every flexible spelling of the pattern has: no little, hyphenated or bracketed ones."""
    words = [w for w in pattern.lower().split() if not re.search(r"[-()]", w) and w not in pt.ARTICLES and w not in pt.OPTIONAL]
    runs = [m[0] for w in words if (m := re.search("[a-z0-9]+", w))]
    return max(runs, key=lambda w: (len(w), w), default=None)


def discover(texts: DataFrame, patterns: DataFrame, scopes: DataFrame | None = None, key: str = "tinyId") -> DataFrame:
    """(pattern, verbatim, key, field_path): spellings of each pattern found by its flexible regex.

    The list goes to the workers in parts (``matching.parts``); there an automaton of the patterns' fixed words
    picks the regexes worth trying on a text, so the texts are read once a part and nothing is shuffled. Patterns
    without a fixed word are tried on every text. With scopes (pattern, key) only hits in the pattern's own records stay.
    """
    rows = None
    for part in matching.parts(patterns.where("trim(pattern) <> ''")):
        some = texts.select(key, "field_path", F.explode(_spellings(texts, part)).alias("m")).select("m.pattern", "m.verbatim", key, "field_path").where("verbatim <> ''")
        rows = some if rows is None else rows.unionByName(some)
    return rows if scopes is None else rows.join(scopes.select("pattern", key).distinct(), ["pattern", key], "left_semi")


def _spellings(texts: DataFrame, part: list[str]) -> Column:
    shared, kept = texts.sparkSession.sparkContext.broadcast(sorted(part)), {}

    @F.pandas_udf("array<struct<pattern:string,verbatim:string>>")
    def found(s: pd.Series) -> pd.Series:
        if not kept:  # once for each task
            a, always = ahocorasick.Automaton(), []
            for p in shared.value:
                if w := fixed_word(p):
                    a.add_word(w, (*a.get(w, ()), p))
                else:
                    always.append(p)
            if len(a):
                a.make_automaton()
            kept.update(a=a, always=always, rx={})

        def one(t):
            if not t:
                return []
            tried = set(kept["always"])
            if len(kept["a"]):
                tried.update(p for _, ps in kept["a"].iter(t.lower()) for p in ps)
            out = []
            for p in sorted(tried):
                if p not in kept["rx"]:
                    kept["rx"][p] = re.compile(pt.flexible_regex(p), re.I)
                out += [{"pattern": p, "verbatim": m[0].strip()} for m in kept["rx"][p].finditer(t)]
            return out

        return s.map(one)

    return found("text")


def undiscovered(patterns: DataFrame, found: DataFrame) -> DataFrame:
    """Patterns without any spelling in the texts."""
    return patterns.select("pattern").distinct().join(found.select("pattern").distinct(), "pattern", "left_anti")


def mask_spans(seqs: DataFrame, names: DataFrame, key: str = "tinyId") -> DataFrame:
    """Token sequences with the tokens of known names (column name) masked before mining.

    Names become token runs and are masked like mined phrases, longest first.
    """
    runs = written(names.select(F.array_join(tx.tokens(F.col("name")), " ").alias("kmer")).where("kmer <> ''").distinct(), "names")
    sizes = sorted((r.n for r in runs.select(F.size(F.split("kmer", " ")).alias("n")).distinct().collect()), reverse=True)
    for k in sizes:
        seqs = written(mining.mask(seqs, runs.where(F.size(F.split("kmer", " ")) == k), k, key), "premasked")
    return seqs


def mask_after(texts: DataFrame, names: list[str], contexts: list[str] = list(pt.ANCHORS), within: int = 5) -> DataFrame:
    """texts with ``masked``: a context phrase and a known name within some words after it become ``[MASK]``.

    The span runs on through a parenthesised acronym. names: a config-sized list.
    """
    known = "|".join(sorted((re.escape(n) for n in names if n), key=lambda n: (-len(n), n))) or r"(?!)"
    rx = re.compile(rf"\b(?:{'|'.join(map(re.escape, contexts))})(?:\s+\S+){{0,{within}}}?\s+(?:{known})(?:\s*\([A-Z][A-Z0-9-]*\))?", re.I)

    @F.pandas_udf("string")
    def masked(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else rx.sub("[MASK]", t))

    return texts.withColumn("masked", masked("text"))


# Punctuation that belongs to a span it touches (fixed values).
LEADING, TRAILING = r"""[(\[{'"“”\-–—]*$""", r"""^[)\]}.,;:?!'"“”\-–—/\\%°]*"""


def extend_span(text: Column, start: Column, end: Column) -> Column:
    """The verbatim text from start to end (0-based, end excluded) with the punctuation that touches it."""
    before, after = F.substring(text, F.lit(1), start), F.substring(text, end + 1, F.length(text))
    return F.concat(F.regexp_extract(before, LEADING, 0), F.substring(text, start + 1, end - start), F.regexp_extract(after, TRAILING, 0))


def whole_text_phrases(texts: DataFrame, k_max: int = 25, least_ids: int = 2, key: str = "tinyId") -> DataFrame:
    """(phrase, k, n_ids): duplicated whole texts longer than the widest window, given apart from the mined ones."""
    t = tx.tokens(F.col("text"))
    rows = texts.select(key, t.alias("t")).where(F.size("t") > k_max).select(key, F.array_join("t", " ").alias("phrase"), F.size("t").alias("k"))
    return rows.groupBy("phrase", "k").agg(F.countDistinct(key).alias("n_ids")).where(F.col("n_ids") >= least_ids)


def prune(phrases: DataFrame, how: str = "global", least: int = 2, key: str = "tinyId") -> DataFrame:
    """Phrases (field, phrase, key) without those inside longer ones: none, threshold, tinyid (within a record) or global."""
    if how == "none":
        return phrases
    if how == "threshold":
        good = phrases.groupBy("field", "phrase").agg(F.countDistinct(key).alias("n")).where(F.col("n") >= least)
        return phrases.join(good.select("field", "phrase"), ["field", "phrase"], "left_semi")
    by = ["field", key] if how == "tinyid" else ["field"]
    inner = mining.sub_windows(phrases.select("phrase").distinct()).withColumnRenamed("long", "phrase")
    covered = phrases.select(*by, "phrase").distinct().join(inner, "phrase").select(*by, F.col("short").alias("phrase")).distinct()
    return phrases.join(covered, [*by, "phrase"], "left_anti")


def mine_subset(texts: DataFrame, abbreviations: DataFrame, k_max: int = 15, k_min: int = 3, least_ids: int = 2, top: int = 10, key: str = "tinyId") -> DataFrame:
    """(abbreviation, phrase, k, n_ids, rank): the widest frequent phrases in the texts that name each abbreviation."""
    hits = matching.literal_hits(texts, abbreviations.select(F.col("abbreviation").alias("pattern")), ignore_case=False, key=key)
    seqs = hits.select(F.col("pattern").alias("abbreviation"), key, tx.tokens(F.col("text")).alias("tokens"))
    grams = F.flatten(F.transform(F.sequence(F.lit(k_min), F.lit(k_max)), lambda k: F.when(F.size("tokens") >= k, F.transform(F.sequence(F.lit(1), F.size("tokens") - k + 1), lambda i: F.struct(k.alias("k"), F.array_join(F.slice("tokens", i, k), " ").alias("phrase")))).otherwise(F.array().cast("array<struct<k:int,phrase:string>>"))))
    n = seqs.select("abbreviation", key, F.explode(F.array_distinct(grams)).alias("g")).distinct().groupBy("abbreviation", "g.k", "g.phrase").agg(F.count("*").alias("n_ids")).where(F.col("n_ids") >= least_ids)
    from pyspark.sql import Window

    w = Window.partitionBy("abbreviation").orderBy(F.desc("k"), F.desc("n_ids"), "phrase")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def field_analysis(hits: DataFrame, least_fields: int = 0, key: str = "tinyId") -> DataFrame:
    """(pattern, counts, profile, example_field, example_text): distribution with the first example by path."""
    dist = matching.field_profile(matching.field_distribution(hits, key))
    example = hits.groupBy("pattern").agg(F.min(F.struct("field_path", key, "text")).alias("e"))
    return dist.join(example, "pattern").where(F.col("n_definition") + F.col("n_designation") >= least_fields).select(*dist.columns, F.col("e.field_path").alias("example_field"), F.col("e.text").alias("example_text"))


def splits(names: DataFrame) -> DataFrame:
    """(name, full, sub, abbreviation): a name cut at its delimiter and acronym.

    ``full`` is what stands before the first `` - `` or ``:``, ``sub`` what follows, ``abbreviation`` a
    parenthesised acronym; a part that would begin with a preposition stays with the whole.
    """
    bare = F.trim(F.regexp_replace("name", r"\s*\(([A-Z][A-Z0-9\-]+)\)", ""))
    cut = F.split(bare, r"\s+[-–]\s+|:\s+", 2)
    sub = F.trim(F.get(cut, F.lit(1)))
    keep = sub.rlike(r"(?i)^(?:of|for|in|on|at|by|to)\b")
    return names.select("name", F.when(keep, bare).otherwise(F.trim(F.get(cut, F.lit(0)))).alias("full"), F.when(~keep, sub).alias("sub"), F.nullif(F.regexp_extract("name", r"\(([A-Z][A-Z0-9\-]+)\)", 1), F.lit("")).alias("abbreviation"))


def strip_patterns(split: DataFrame, decisions: DataFrame) -> DataFrame:
    """(pattern, kind): patterns of the names kept for stripping; short ones (under three words) as word-bounded regexes.

    decisions: (name, decision); blank, keep, strip and approve strip, modify uses the modification.
    """
    d = F.lower(F.trim(F.coalesce("decision", F.lit(""))))
    rows = split.join(decisions.select("name", "decision", "modification"), "name", "left").where(d.isin("", "keep", "strip", "approve", "modify"))
    parts = F.array(F.struct(F.lit("full").alias("kind"), F.when(d == "modify", F.coalesce("modification", "full")).otherwise(F.col("full")).alias("p")), F.struct(F.lit("sub").alias("kind"), F.col("sub").alias("p")), F.struct(F.lit("abbreviation").alias("kind"), F.col("abbreviation").alias("p")))
    each = rows.select(F.explode(parts).alias("x")).select("x.kind", "x.p").where("p is not null and p <> ''")
    quoted = F.regexp_replace("p", r"([.^$*+?()\[\]{}|\\])", r"\\$1")
    pattern = F.when((F.col("kind") == "abbreviation") | (tx.word_count(F.col("p")) < 3), F.concat(F.lit("REGEX:\\b"), quoted, F.lit("\\b"))).otherwise(F.col("p"))
    return each.select(pattern.alias("pattern"), "kind").distinct()


def supplementary(texts: DataFrame, names: DataFrame, english: list[str] = (), key: str = "tinyId") -> DataFrame:
    """(key, field_path, name, acronym): known names anywhere in a text; short capital names that are words need an anchor.

    names: (name, acronym). One hit for each text and name.
    """
    guarded = F.col("pattern").rlike(r"^[A-Z]{2,5}$") & F.lower("pattern").isin(*english)
    hits = matching.literal_hits(texts, names.select(F.col("name").alias("pattern")), ignore_case=False, key=key)
    anchored = F.lower("text").rlike("(?:" + "|".join(pt.ANCHORS) + r")\s+(?:the\s+)?\S*")
    ok = hits.where(~guarded | anchored) if english else hits
    return ok.select(key, "field_path", F.col("pattern").alias("name")).distinct().join(names.select("name", "acronym").distinct(), "name").select(key, "field_path", "name", "acronym")


def abbreviation_patterns(texts: DataFrame, abbreviations: DataFrame, key: str = "tinyId") -> DataFrame:
    """(abbreviation, form, n_ids): ``[ABC]``, ``ABC - x`` and ``.. (ABC) - x`` by form and distinct records."""
    found = []
    for form, p in (("bracketed", r"\[([A-Z][A-Z0-9\-]+)\]"), ("leading", r"^([A-Z][A-Z0-9\-]+)\s+[-–]\s"), ("parenthesised", r"\(([A-Z][A-Z0-9\-]+)\)")):
        found.append(texts.select(key, F.lit(form).alias("form"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(p), F.lit(1)))).alias("abbreviation")))
    rows = found[0].unionByName(found[1]).unionByName(found[2])
    return rows.join(abbreviations.select("abbreviation").distinct(), "abbreviation", "left_semi").groupBy("abbreviation", "form").agg(F.countDistinct(key).alias("n_ids"))


def suggest(missing: DataFrame, words: int = 3, least: int = 2) -> DataFrame:
    """(prefix, n, regex): beginnings that several missed texts share, as a flexible regex; missing: (text)."""
    t = F.split(F.lower(F.trim("text")), r"\s+")
    n = missing.where(F.size(t) >= words).select(F.array_join(F.slice(t, 1, words), " ").alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    quoted = F.regexp_replace("prefix", r"([.^$*+?()\[\]{}|\\])", r"\\$1")
    return n.withColumn("regex", F.concat(F.lit(r"(?i)\b"), F.regexp_replace(quoted, r"[\s\-]+", r"[-\\s]+"), F.lit(r"\b")))


def reference_text(documents: Column) -> Column:
    """Texts of reference documents (array<struct<document, text>>), document before text, joined by ``;; ``."""
    each = F.transform(documents, lambda d: F.coalesce(F.nullif(d["document"], F.lit("")), d["text"]))
    return F.array_join(F.filter(F.transform(each, lambda s: tx.flatten_lines(F.trim(s))), lambda s: s.isNotNull() & (s != "")), ";; ")


def variant_rows(wide: DataFrame, codes: list[str], keep: list[str]) -> DataFrame:
    """One row for each variant column, ready for a write partitioned by variant."""
    return wide.select(*keep, F.explode(F.array(*[F.struct(F.lit(c).alias("variant"), F.col(c).alias("text")) for c in codes])).alias("x")).select(*keep, "x.*")


def export_abbreviations(entries: DataFrame, categories: tuple[str, ...] = ("instrument", "study"), least_confidence: float = 0.8) -> DataFrame:
    """(abbreviation, expansion, target): strip (decided, or of a category and sure), review (unsure) or skip, a decision first."""
    sure = F.col("category").isin(*categories) & (F.col("confidence") >= least_confidence)
    target = F.when(F.col("decision").isin("strip", "skip"), F.col("decision")).when(sure, "strip").when(F.col("category").isin(*categories) | (F.col("category") == "unknown"), "review").otherwise("skip")
    return entries.select("abbreviation", "expansion", target.alias("target"))


def classify_batches(phrases: DataFrame, client: Callable[[list[str]], list[dict]], categories: list[str], provider: str = "offline", batch: int = 20) -> DataFrame:
    """(phrase_id, provider, category, confidence, reasoning): phrases through a client in batches.

    client: texts -> a dict each with category, confidence, reasoning, in the same order; it may call any
    service. A category that is not listed, a short answer or an error gives confidence 0, which does not vote.
    """

    def run(frames):
        for pdf in frames:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                try:
                    answers = list(client(part["text"].tolist()))
                except Exception as e:  # one failed batch must not end the job
                    answers = [{"reasoning": f"error: {type(e).__name__}"}] * len(part)
                answers += [{"reasoning": "no answer"}] * (len(part) - len(answers))
                rows = []
                for pid, a in zip(part["phrase_id"], answers):
                    good = a.get("category") in categories
                    rows.append((pid, provider, a.get("category") if good else categories[0], float(a.get("confidence", 0.0)) if good else 0.0, a.get("reasoning", "")))
                yield pd.DataFrame(rows, columns=["phrase_id", "provider", "category", "confidence", "reasoning"])

    return phrases.select("phrase_id", "text").mapInPandas(run, "phrase_id string, provider string, category string, confidence double, reasoning string")


def keyword_client(rules: dict[str, str], default: str) -> Callable[[list[str]], list[dict]]:
    """An offline client: the first category whose regex matches, else the default with low confidence."""

    def answer(texts: list[str]) -> list[dict]:
        out = []
        for t in texts:
            hit = next((c for c, p in rules.items() if re.search(p, t or "", re.I)), None)
            out.append({"category": hit or default, "confidence": 0.9 if hit else 0.3, "reasoning": "keyword" if hit else "default"})
        return out

    return answer


_IRREGULAR = {"children": "child", "people": "person", "men": "man", "women": "woman", "feet": "foot", "teeth": "tooth", "mice": "mouse", "was": "be", "were": "be", "is": "be", "are": "be", "been": "be", "has": "have", "had": "have"}


def lemma(token: Column) -> Column:
    """A small rule lemmatiser: irregular forms, plural and verb endings; swap in another expression where a library is at hand."""
    t = token
    out = F.when(t.rlike("(?:ss|us|is)$") | (F.length(t) < 4), t).when(t.rlike("ies$") & (F.length(t) > 4), F.regexp_replace(t, "ies$", "y")).when(t.rlike("(?:ches|shes|sses|xes|zes)$"), F.regexp_replace(t, "es$", "")).when(t.rlike("[^s]s$"), F.regexp_replace(t, "s$", "")).when(t.rlike("[b-df-hj-np-tv-z]{2}ing$|[aeiou][a-z]+[aeiou][a-z]ing$"), F.regexp_replace(t, "ing$", "")).otherwise(t)
    for form, base in _IRREGULAR.items():
        out = F.when(t == form, base).otherwise(out)
    return out


def answer_in(text: str, categories: list[str]) -> dict:
    """category, confidence and reasoning from a service's answer: JSON anywhere in the text, else the only category it names.

    An answer without a listed category has confidence 0. Confidence is held within 0 and 1.
    """
    for m in re.finditer(r"\{[^{}]*\}", text or ""):
        try:
            d = json.loads(m[0])
        except ValueError:
            continue
        low = {c.lower(): c for c in categories}
        if (c := low.get(str(d.get("category", "")).strip().lower())) is not None:
            try:
                sure = min(1.0, max(0.0, float(d.get("confidence", 0.5))))
            except (TypeError, ValueError):
                sure = 0.0
            return {"category": c, "confidence": sure, "reasoning": str(d.get("reasoning", ""))}
    named = [c for c in categories if re.search(rf"\b{re.escape(c)}\b", text or "", re.I)]
    return {"category": named[0], "confidence": 0.5, "reasoning": "named in text"} if len(named) == 1 else {"category": None, "confidence": 0.0, "reasoning": "no category"}


def paced(client: Callable[[list[str]], list[dict]], per_minute: float = 60.0, retries: int = 3, most_wait: float = 60.0, clock=time.monotonic, sleep=time.sleep) -> Callable[[list[str]], list[dict]]:
    """A client that keeps to a rate (token bucket) and tries again after errors, each time waiting twice as long up to ``most_wait``.

    The rate holds in one task; give each task its part of a service's limit. The last error is raised.
    """
    state = {"tokens": per_minute, "at": None}

    def call(texts: list[str]) -> list[dict]:
        for n in range(retries + 1):
            now = clock()
            if state["at"] is not None:
                state["tokens"] = min(per_minute, state["tokens"] + (now - state["at"]) * per_minute / 60)
            state["at"] = now
            if state["tokens"] < 1:
                sleep((1 - state["tokens"]) * 60 / per_minute)
                state["tokens"], state["at"] = 1, clock()
            state["tokens"] -= 1
            try:
                return client(texts)
            except Exception:
                if n == retries:
                    raise
                sleep(min(most_wait, 2.0**n) * (1 + 0.1 * random.random()))
        raise AssertionError

    return call


PROMPT = "Classify each phrase into one of: {categories}.{hint} Answer with one JSON object a phrase, keys category, confidence (0 to 1), reasoning.\n\n{phrases}"


def question(texts: list[str], categories: list[str], hint: str = "", template: str = PROMPT) -> str:
    """The text that asks a service about a batch; template with {categories}, {hint}, {phrases}."""
    listed = "\n".join(f"{i}. {t}" for i, t in enumerate(texts, 1))
    return template.format(categories=", ".join(categories), hint=f" {hint}" if hint else "", phrases=listed)


def text_client(ask: Callable[[str], str], categories: list[str], hint: str = "") -> Callable[[list[str]], list[dict]]:
    """A batch client over a service that answers texts: one JSON object a phrase, in order."""

    def call(texts: list[str]) -> list[dict]:
        reply = ask(question(texts, categories, hint))
        found = re.findall(r"\{[^{}]*\}", reply or "")
        return [answer_in(x, categories) for x in found] if found else [answer_in(reply, categories)] if len(texts) == 1 else []

    return call


def discovery_run(texts: DataFrame, patterns: DataFrame, parents: DataFrame | None = None, scopes: DataFrame | None = None, least_ids: int = 2, least_words: int = 2, key: str = "tinyId") -> DataFrame:
    """(pattern, verbatim, pass, n_ids, n_definition, n_designation, parent_phrase): spellings found in two passes.

    First the patterns as they are, then the bare names (of ``least_words`` words or more) of those with an anchor, also
    bound to the scopes (pattern, key) if given. Spellings in fewer than ``least_ids`` records go.
    """
    listed = patterns.select("pattern").where("pattern is not null").distinct()
    bare = listed.select("pattern", pt.bare_column(F.col("pattern")).alias("bare")).where((F.col("bare") != F.col("pattern")) & (F.size(F.split("bare", r"\s+")) >= least_words))
    bare = written(bare, "bare-names")
    one = discover(texts, listed, scopes, key).withColumn("pass", F.lit("pattern"))
    two = discover(texts, bare.select(F.col("bare").alias("pattern")).distinct(), None, key).withColumnRenamed("pattern", "bare").join(bare, "bare")
    if scopes is not None:
        two = two.join(scopes.select("pattern", key).distinct(), ["pattern", key], "left_semi")
    hits = one.select("pattern", "verbatim", "pass", key, "field_path").unionByName(two.select("pattern", "verbatim", F.lit("bare").alias("pass"), key, "field_path"))
    field = lambda f: F.max(F.startswith("field_path", F.lit(f)).cast("int"))
    per = hits.groupBy("pattern", "verbatim", key).agg(F.max("pass").alias("pass"), field("definitions").alias("d"), field("designations").alias("g"))
    out = per.groupBy("pattern", "verbatim").agg(F.max("pass").alias("pass"), F.count("*").alias("n_ids"), F.sum("d").alias("n_definition"), F.sum("g").alias("n_designation")).where(F.col("n_ids") >= least_ids)
    if parents is None:
        return out.withColumn("parent_phrase", F.lit(None).cast("string"))
    return out.join(parents.groupBy("pattern").agg(F.min("parent_phrase").alias("parent_phrase")), "pattern", "left")


def strip_mode(table_: DataFrame) -> str:
    """``splits`` if the table has proposed columns (full, sub or abbreviation), else ``legacy``."""
    return "splits" if {"full", "sub", "abbreviation", "proposed_full", "proposed_sub"} & {c.lower() for c in table_.columns} else "legacy"


def rematch(texts: DataFrame, patterns: DataFrame, key: str = "tinyId") -> DataFrame:
    """(pattern, n_ids): records in which each pattern stands, literally or as ``REGEX:`` with word bounds; patterns found nowhere have no row."""
    plain = patterns.select("pattern").distinct()
    literal = matching.literal_hits(texts, plain.where("not pattern like 'REGEX:%'"), ignore_case=False, key=key).select("pattern", key)
    bounded = plain.where("pattern like 'REGEX:%'").select("pattern", F.regexp_replace(F.regexp_replace("pattern", r"^REGEX:\\b|\\b$", ""), r"\\(.)", "$1").alias("word"))
    near = matching.literal_hits(texts, bounded.select(F.col("word").alias("pattern")), ignore_case=False, key=key).withColumnRenamed("pattern", "word").join(bounded, "word")
    edge = F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), F.col("word"), F.lit(r"\E(?![A-Za-z0-9_])"))
    return literal.unionByName(near.where(F.rlike("text", edge)).select("pattern", key)).groupBy("pattern").agg(F.countDistinct(key).alias("n_ids"))


def residual_text(texts: DataFrame, phrases: DataFrame, key: str = "tinyId") -> DataFrame:
    """(key, field_path, rest): the tokens of each text that no phrase (column name) covers, longest phrases first."""
    seqs = mask_spans(mining.sequences(texts, key), phrases, key)
    kept = F.filter(F.arrays_zip("tokens", "free"), lambda x: x["free"])
    return seqs.select(key, "field_path", F.array_join(F.transform(kept, lambda x: x["tokens"]), " ").alias("rest"))


def rare_but_listed(rare: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rare words (word, ..) without those of a list of allowed words (word), case aside."""
    return rare.withColumn("_l", F.lower("word")).join(allowed.select(F.lower("word").alias("_l")).distinct(), "_l", "left_anti").drop("_l")
