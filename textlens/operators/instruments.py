"""Instrument mentions, acronyms, abbreviations, spelling variants, families."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textlens.functions import text as tx

# Lead-ins of a mention, what may stand between lead-in and name, and units that count its items (fixed values).
LEADS, UNITS = ("as part of", "as a part of", "based on", "field of"), ("item", "question", "point")


def mention_grammar(leads: tuple[str, ...] = LEADS, units: tuple[str, ...] = UNITS) -> tuple[str, str]:
    """(mention, acronym only): regexes made from the grammar of mentions, for Java and RE2.

    mention := lead, [version n of], [the], [n-unit], name, [(acronym)]; a name is a capitalised word and one
    or more words or numbers behind it, a dash may stand between; groups 1 and 2 are name and acronym.
    """
    word = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*"
    optional = lambda *parts: "".join(f"(?:{p}\\s+)?" for p in parts)
    lead = "(?i:" + "|".join(r"\s+".join(x.split()) for x in sorted(leads, key=len, reverse=True)) + r")\s+"
    name = rf"\p{{Lu}}(?:{word})?(?:\s+(?:-\s+)?{word})+"
    acronym = r"\((\p{Lu}[\p{Lu}\p{N}]*(?:[ -][\p{Lu}\p{N}]+)*)\)"
    between = optional(r"version\s+[\d.]+\s+of", "the", r"\d+[-\s](?:" + "|".join(units) + ")")
    return rf"{lead}{between}({name})(?:\s*{acronym})?", rf"{lead}{optional('the')}{acronym}"


MENTION, ACRONYM_ONLY = mention_grammar()
# Short words that title case leaves in lower case (fixed values).
MINOR = "a an the and as but for if nor or so yet at by in of off on per to up via".split()


def well_cased(name: Column, least_words: int = 3) -> Column:
    """Whether more than 60 % of the words are cased as in a title, of at least ``least_words`` words."""
    words = F.split(F.trim(name), r"\s+")
    good = F.filter(words, lambda w: w.rlike(r"^\d+$") | F.lower(w).isin(*MINOR) | F.regexp_replace(w, "[^A-Za-z]", "").rlike("^[A-Z]"))
    return (F.size(words) >= least_words) & (F.size(good) / F.size(words) > 0.6)


def mentions(texts: DataFrame, least_words: int = 3, key: str = "tinyId") -> DataFrame:
    """(key, field_path, full_match, instrument_name, acronym): mentions after an anchor phrase, in the JVM."""
    found = F.transform(F.regexp_extract_all("text", F.lit(f"({MENTION})"), F.lit(1)), lambda m: F.struct(m.alias("full_match"), F.trim(F.regexp_extract(m, MENTION, 1)).alias("instrument_name"), F.nullif(F.regexp_extract(m, MENTION, 2), F.lit("")).alias("acronym")))
    rows = texts.select(key, "field_path", F.explode(found).alias("m")).select(key, "field_path", "m.*")
    return rows.where(well_cased(F.col("instrument_name"), least_words))


def acronym_mentions(texts: DataFrame, names: DataFrame, key: str = "tinyId") -> DataFrame:
    """Mentions by acronym only; names: (acronym, instrument_name), unknown ones keep ``[ABC]``."""
    rows = texts.select(key, "field_path", F.explode(F.regexp_extract_all("text", F.lit(ACRONYM_ONLY), F.lit(1))).alias("acronym"))
    return rows.join(names.select("acronym", "instrument_name"), "acronym", "left").select(key, "field_path", F.coalesce("instrument_name", F.concat(F.lit("["), "acronym", F.lit("]"))).alias("instrument_name"), "acronym")


def acronym_names(found: DataFrame) -> DataFrame:
    """(acronym, instrument_name): the most frequent name of each acronym, ties by name."""
    n = found.where("acronym is not null").groupBy("acronym", "instrument_name").agg(F.count("*").alias("n"))
    return n.groupBy("acronym").agg(F.min(F.struct((-F.col("n")).alias("m"), "instrument_name")).alias("b")).select("acronym", "b.instrument_name")


def catalog(found: DataFrame, least_ids: int = 2, key: str = "tinyId") -> DataFrame:
    """(name_key, instrument_name, n, n_ids, acronyms): mentions by normalised name, the most frequent surface form."""
    rows = found.select(tx.norm_name(F.col("instrument_name")).alias("name_key"), "instrument_name", "acronym", key)
    forms = rows.groupBy("name_key", "instrument_name").agg(F.count("*").alias("c"), F.array_distinct(F.collect_set("acronym")).alias("acr"))
    by = forms.groupBy("name_key").agg(F.sum("c").alias("n"), F.min(F.struct((-F.col("c")).alias("m"), "instrument_name")).alias("b"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("acr")))), "|").alias("acronyms"))
    ids = rows.groupBy("name_key").agg(F.countDistinct(key).alias("n_ids"))
    return by.join(ids, "name_key").where(F.col("n_ids") >= least_ids).select("name_key", "b.instrument_name", "n", "n_ids", "acronyms")


def surface_forms(found: DataFrame, key: str = "tinyId") -> DataFrame:
    """(instrument_name, n, n_ids, acronym): one row for each surface form, with its most frequent acronym."""
    n = found.groupBy("instrument_name").agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_ids"))
    a = found.where("acronym is not null").groupBy("instrument_name", "acronym").agg(F.count("*").alias("c"))
    best = a.groupBy("instrument_name").agg(F.min(F.struct((-F.col("c")).alias("m"), "acronym")).alias("b"))
    return n.join(best, "instrument_name", "left").select("instrument_name", "n", "n_ids", "b.acronym")


def spelling_variants(found: DataFrame, ratio: float = 0.85, short_ratio: float = 0.95, short: int = 12) -> DataFrame:
    """(acronym, name, canonical, variant_type): spellings merged within an acronym by matching-block ratio.

    Distinct (acronym, name, n) rows meet by acronym; the most frequent name that is near enough wins. An
    acronym's distinct names are metadata; pairs are made only with names that are more frequent.
    """
    names = found.where("acronym is not null").groupBy("acronym", F.col("instrument_name").alias("name")).agg(F.count("*").alias("n"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, leaders = [], []
        for name, n in sorted(zip(pdf["name"], pdf["n"]), key=lambda x: (-x[1], x[0])):
            best = next((c for c in leaders if difflib.SequenceMatcher(None, name.lower(), c.lower(), autojunk=False).ratio() >= (short_ratio if min(len(name), len(c)) < short else ratio)), None)
            if best is None:
                leaders.append(name)
                best = name
            rows.append((pdf["acronym"].iloc[0], name, best, variant_type(name, best)))
        return pd.DataFrame(rows, columns=["acronym", "name", "canonical", "variant_type"])

    return names.groupBy("acronym").applyInPandas(lambda pdf: merge(pdf), "acronym string, name string, canonical string, variant_type string")


def variant_type(name: str, canonical: str) -> str:
    """same, case, deletion, insertion, substitution or mixed."""
    if name == canonical:
        return "same"
    if name.lower() == canonical.lower():
        return "case"
    kinds = {tag for tag, *_ in difflib.SequenceMatcher(None, canonical.lower(), name.lower(), autojunk=False).get_opcodes() if tag != "equal"}
    return {"delete": "deletion", "insert": "insertion", "replace": "substitution"}[kinds.pop()] if len(kinds) == 1 else "mixed"


def families(names: DataFrame, rules: list[tuple[str, str, float]], false_positives: str | None = None) -> DataFrame:
    """(instrument_name, family_id, confidence): the first family whose regex matches; else ``other`` 0.5.

    rules: (family, regex, confidence) in order. Names that match ``false_positives`` are ``unknown`` 0.0.
    """
    c, conf = F.lit("other"), F.lit(0.5)
    for family, pattern, confidence in reversed(rules):
        hit = F.col("instrument_name").rlike(f"(?i){pattern}")
        c, conf = F.when(hit, family).otherwise(c), F.when(hit, confidence).otherwise(conf)
    if false_positives:
        bad = F.col("instrument_name").rlike(f"(?i){false_positives}")
        c, conf = F.when(bad, "unknown").otherwise(c), F.when(bad, 0.0).otherwise(conf)
    return names.select("instrument_name", c.alias("family_id"), conf.alias("confidence")).distinct()


def family_summary(found: DataFrame, assigned: DataFrame, key: str = "tinyId") -> DataFrame:
    """(family_id, n_instruments, n_ids, n): true distinct records, not a sum of distinct counts."""
    return found.join(assigned, "instrument_name").groupBy("family_id").agg(F.countDistinct("instrument_name").alias("n_instruments"), F.countDistinct(key).alias("n_ids"), F.count("*").alias("n"))


# ---- abbreviations

_PAREN = r"([^(]{3,200})\(([A-Z][A-Z0-9](?:[A-Z0-9\-]*[A-Z0-9])?)\)"
# Words an expansion does not begin with (fixed values).
FILLERS = "a an the of in for and or to on by with at from as".split()


def aligned(text: Column, abbreviation: Column) -> Column:
    """The tail of text whose word initials spell the abbreviation (as a subsequence); the whole text if none does.

    Letters are taken from the last to the first, initials from the right to the left: where the first letter
    finds its place the tail begins. Parts of a hyphenated word have initials of their own. All in the JVM.
    """
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: w.rlike(r"[^\s,;:]"))
    letters = F.regexp_extract_all(F.upper(abbreviation), F.lit("[A-Z]"), F.lit(0))
    parts = lambda w: F.filter(F.split(w, "[-/]"), lambda p: p.rlike(r"^[\s,;:]*[A-Za-z]"))
    initials = F.flatten(F.transform(words, lambda w, i: F.transform(parts(w), lambda p: F.struct(i.alias("at"), F.upper(F.regexp_extract(p, "[A-Za-z]", 0)).alias("letter")))))
    begin = F.struct(F.size(letters).alias("left"), F.lit(-1).alias("at"))
    fits = lambda acc, x: (acc["left"] > 0) & (x["letter"] == F.get(letters, acc["left"] - 1))
    found = F.aggregate(F.reverse(initials), begin, lambda acc, x: F.when(fits(acc, x), F.struct((acc["left"] - 1).alias("left"), x["at"].alias("at"))).otherwise(acc))
    tail = F.array_join(F.slice(words, found["at"] + 1, F.size(words)), " ")
    cut = F.regexp_replace(F.regexp_replace(tail, rf"(?i)^(?:(?:{'|'.join(FILLERS)})\s+)+(?=\S)", ""), r"^[\s,;:]+|[\s,;:]+$", "")
    return F.when((F.size(letters) > 0) & (found["left"] == 0) & (cut != ""), cut).otherwise(F.trim(text))


def parenthetical(texts: DataFrame, key: str = "tinyId") -> DataFrame:
    """(abbreviation, expansion, n_ids, confidence) of ``Full Name (ABC)``; the expansion most often aligned."""

    found = F.transform(F.regexp_extract_all("text", F.lit(f"({_PAREN})"), F.lit(1)), lambda m: F.struct(F.regexp_extract(m, _PAREN, 1).alias("t"), F.regexp_extract(m, _PAREN, 2).alias("abbreviation")))
    rows = texts.select(key, F.explode(found).alias("m")).select(key, "m.*")
    rows = rows.withColumn("expansion", F.regexp_replace(aligned(F.col("t"), F.col("abbreviation")), r"(?i)^(?:the|a|an)\s+", ""))
    n = rows.groupBy("abbreviation", "expansion").agg(F.count("*").alias("n"))
    best = n.groupBy("abbreviation").agg(F.min(F.struct((-F.col("n")).alias("m"), "expansion")).alias("b"))
    ids = rows.groupBy("abbreviation").agg(F.countDistinct(key).alias("n_ids"))
    return best.join(ids, "abbreviation").select("abbreviation", "b.expansion", "n_ids", F.lit(0.95).alias("confidence"))


def tagged(texts: DataFrame, pattern: str, source: str, confidence: float, least: int = 2, key: str = "tinyId") -> DataFrame:
    """(abbreviation, source, n_ids, confidence): tokens that a regex group finds, once for each text."""
    rows = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))).alias("abbreviation")).where(F.length("abbreviation") >= least)
    return rows.groupBy("abbreviation").agg(F.countDistinct(key).alias("n_ids")).select("abbreviation", F.lit(source).alias("source"), "n_ids", F.lit(confidence).alias("confidence"))


# Abbreviations by form: in brackets at the end, a last word in capitals, a word with a capital inside.
BRACKETED = r"\[(\p{Lu}[\p{L}\p{N} ./-]+)\]\s*$"
BARE_CAPS = r"(?:^|[^\p{L}\p{N}_])(\p{Lu}[\p{Lu}\p{N}-]+)\s*$"
INTERCAPS = r"\b([A-Za-z]*\p{Ll}\p{Lu}[A-Za-z]*)\b"


def bare_capitals(texts: DataFrame, key: str = "tinyId") -> DataFrame:
    """Capital tokens at the end of a text; texts of two tokens or more that are all in capitals do not count."""
    tokens = F.split(F.trim("text"), r"\s+")
    shouting = (F.size(tokens) >= 2) & F.forall(F.filter(tokens, lambda t: t.rlike("^[A-Za-z]+$")), lambda t: t == F.upper(t))
    return tagged(texts.where(~shouting), BARE_CAPS, "bare_caps", 0.5, key=key)


def classify_abbreviations(entries: DataFrame) -> DataFrame:
    """entries with ``category`` by the words of the expansion (null expansion: unknown)."""
    e = F.lower(F.coalesce("expansion", F.lit("")))
    kind = F.when(e == "", "unknown").when(e.rlike(r"\b(questionnaire|scale|inventory|index|survey|checklist|battery|interview|test|form|schedule)\b"), "instrument").when(e.rlike(r"\b(study|trial|cohort|registry)\b"), "study").when(e.rlike(r"\b(institute|consortium|network|university|society)\b"), "organization").otherwise("medical_term")
    return entries.withColumn("category", kind)


def merge_dictionaries(old: DataFrame, new: DataFrame, growth: float = 3.0) -> DataFrame:
    """(abbreviation, decision, n_ids, note): earlier decisions stay; a skipped entry grown ``growth`` times is tentative again."""
    j = old.select("abbreviation", F.col("decision").alias("d0"), F.col("n_ids").alias("n0")).join(new.select("abbreviation", F.col("decision").alias("d1"), F.col("n_ids").alias("n1")), "abbreviation", "full")
    grown = (F.col("d0") == "skip") & F.col("d1").isNull() & (F.col("n1") >= growth * F.col("n0"))
    note = F.when(grown, F.concat(F.lit("grew "), "n0", F.lit(" to "), "n1"))
    return j.select("abbreviation", F.when(grown, "tentative_skip").otherwise(F.coalesce("d1", "d0", F.lit("tentative"))).alias("decision"), F.greatest(F.coalesce("n0", F.lit(0)), F.coalesce("n1", F.lit(0))).alias("n_ids"), note.alias("note"))


def context_expansions(texts: DataFrame, abbreviations: DataFrame, key: str = "tinyId") -> DataFrame:
    """(abbreviation, expansion, source): the first ``Full Name (ABC)`` in the abbreviation's own records, by record, field and place.

    abbreviations: (abbreviation, key), the records each occurs in. Source is ``context``.
    """
    pair = F.transform(F.regexp_extract_all("text", F.lit(f"({_PAREN})"), F.lit(1)), lambda m: F.struct(F.regexp_extract(m, _PAREN, 1).alias("t"), F.regexp_extract(m, _PAREN, 2).alias("abbreviation")))
    rows = texts.select(key, "field_path", F.posexplode(pair).alias("place", "m")).select(key, "field_path", "place", "m.*")
    own = rows.join(abbreviations.select("abbreviation", key).distinct(), ["abbreviation", key])
    first = own.groupBy("abbreviation").agg(F.min(F.struct(key, "field_path", "place", "t")).alias("f")).select("abbreviation", aligned(F.col("f.t"), F.col("abbreviation")).alias("expansion"))
    return first.select("abbreviation", F.regexp_replace("expansion", r"(?i)^(?:the|a|an)\s+", "").alias("expansion"), F.lit("context").alias("source"))


def expand_abbreviations(entries: DataFrame, context: DataFrame, catalog_names: DataFrame) -> DataFrame:
    """entries (abbreviation, expansion, ..) with missing expansions from their own texts, else from the catalog of instrument names.

    context: (abbreviation, expansion). catalog_names: (acronym, instrument_name). ``expansion_source`` tells which.
    """
    a = context.select("abbreviation", F.col("expansion").alias("_context"))
    b = catalog_names.select(F.col("acronym").alias("abbreviation"), F.col("instrument_name").alias("_catalog"))
    j = entries.join(a, "abbreviation", "left").join(b, "abbreviation", "left")
    have = F.nullif(F.trim("expansion"), F.lit(""))
    source = F.when(have.isNotNull(), "given").when(F.col("_context").isNotNull(), "context").when(F.col("_catalog").isNotNull(), "catalog")
    rest = [c for c in entries.columns if c not in ("abbreviation", "expansion")]
    return j.select("abbreviation", F.coalesce(have, "_context", "_catalog").alias("expansion"), *rest, source.alias("expansion_source"))


def abbreviation_pipeline(texts: DataFrame, catalog_names: DataFrame, old: DataFrame | None = None, key: str = "tinyId") -> DataFrame:
    """(abbreviation, expansion, expansion_source, category, confidence, source, n_ids, decision): discover in every form, expand, classify, merge.

    Of several forms of one abbreviation the surest counts; its records are those of all forms. old: an earlier
    dictionary (abbreviation, decision, n_ids), whose decisions stay.
    """
    paren = parenthetical(texts, key).select("abbreviation", F.lit("parenthetical").alias("source"), "n_ids", "confidence", "expansion")
    others = [tagged(texts, BRACKETED, "bracketed", 0.85, key=key), tagged(texts, INTERCAPS, "intercaps", 0.7, 3, key=key), bare_capitals(texts, key)]
    rows = paren
    for o in others:
        rows = rows.unionByName(o.withColumn("expansion", F.lit(None).cast("string")))
    best = rows.groupBy("abbreviation").agg(F.max(F.struct("confidence", "source", "expansion")).alias("b"), F.max("n_ids").alias("n_ids"))
    entries = best.select("abbreviation", "b.expansion", "b.source", "b.confidence", "n_ids")
    seen = texts.select(key, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\(([A-Z][A-Z0-9-]+)\)"), F.lit(1)))).alias("abbreviation"))
    full = classify_abbreviations(expand_abbreviations(entries, context_expansions(texts, seen, key), catalog_names))
    known = old if old is not None else full.select("abbreviation", F.lit(None).cast("string").alias("decision"), "n_ids").limit(0)
    merged = merge_dictionaries(known, full.select("abbreviation", F.lit(None).cast("string").alias("decision"), "n_ids"))
    return full.join(merged.select("abbreviation", "decision"), "abbreviation")


def token_spans(texts: DataFrame, spans: DataFrame, key: str = "tinyId") -> DataFrame:
    """(key, field_path, char_start, char_end, token_start, token_end): the tokens that a span of characters touches; end excluded, null if none.

    spans: (key, field_path, char_start, char_end).
    """
    piece = tx.pieces(F.col("text"))
    word = F.transform(piece, lambda p: F.struct(F.length(p).alias("n"), F.length(F.regexp_extract(p, f"[{tx.LETTERS}]+$", 0)).alias("w")))
    ends = F.aggregate(word, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x["n"])))
    rows = texts.select(key, "field_path", word.alias("word"), ends.alias("ends")).join(spans.select(key, "field_path", "char_start", "char_end"), [key, "field_path"])
    touched = F.filter(F.sequence(F.lit(1), F.size("ends")), lambda i: (F.element_at("ends", i) > F.col("char_start")) & (F.element_at("ends", i) - F.element_at("word", i)["w"] < F.col("char_end")))
    hit = F.when(F.size("ends") > 0, touched)
    return rows.select(key, "field_path", "char_start", "char_end", (F.array_min(hit) - 1).alias("token_start"), F.array_max(hit).alias("token_end"))


def three_passes(texts: DataFrame, supplementary: DataFrame, least_words: int = 3, key: str = "tinyId") -> DataFrame:
    """(key, field_path, instrument_name, acronym, source): full mentions; acronym-only mentions named by the first pass; known names anywhere.

    supplementary: (name, acronym). A name found by an earlier pass in a text is not given again.
    """
    from textlens.operators.discovery import supplementary as known_names

    one = mentions(texts, least_words, key).select(key, "field_path", "instrument_name", "acronym", F.lit("full").alias("source"))
    names = acronym_names(one.select("instrument_name", "acronym"))
    two = acronym_mentions(texts, names, key).select(key, "field_path", "instrument_name", "acronym", F.lit("acronym").alias("source"))
    three = known_names(texts, supplementary, key=key).select(key, "field_path", F.col("name").alias("instrument_name"), "acronym", F.lit("supplementary").alias("source"))
    rank = F.when(F.col("source") == "full", 0).when(F.col("source") == "acronym", 1).otherwise(2)
    every = one.unionByName(two).unionByName(three)
    best = every.groupBy(key, "field_path", "instrument_name").agg(F.min(F.struct(rank.alias("r"), "source", "acronym")).alias("b"))
    return best.select(key, "field_path", "instrument_name", "b.acronym", "b.source")


def sub_instrument(name: Column) -> Column:
    """struct<instrument_id, sub_instrument>: slug of what stands before the first `` - `` or ``:``, and what follows."""
    cut = F.split(F.trim(name), r"\s+[-–]\s+|:\s+", 2)
    return F.struct(tx.slug(F.get(cut, F.lit(0))).alias("instrument_id"), F.nullif(F.trim(F.get(cut, F.lit(1))), F.lit("")).alias("sub_instrument"))
