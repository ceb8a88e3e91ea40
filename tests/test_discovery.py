"""Discovery, masking, pruning, splits, classification; pattern generators."""

import re

import pytest
from pyspark.sql import functions as F

from textlens.operators import discovery as dc, mining, patterns as pt


def _t(spark, pairs):
    return spark.createDataFrame([(i, "definition", f"d[{n}]", t) for n, (i, t) in enumerate(pairs)], "tinyId string, field string, field_path string, text string")


def test_discover_equals_all_pairs(spark):
    texts = [("A", "as  part of Neuro QOL today"), ("B", "The neuro-qol, twice: NeuroQOL"), ("C", "scale version 2.0."), ("D", "nothing"), ("E", "")]
    pats = ["as part of the Neuro-QOL", "Neuro-QOL", "scale version 2", "the"]
    got = {(r.pattern, r.tinyId, r.verbatim) for r in dc.discover(_t(spark, texts), spark.createDataFrame([(p,) for p in pats], "pattern string")).collect()}
    want = {(p, i, m[0].strip()) for p in pats for i, t in texts for m in re.compile(pt.flexible_regex(p), re.I).finditer(t) if m[0].strip()}
    assert got == want


def test_discover_in_scope_only(spark):
    t = _t(spark, [("A", "foo bar"), ("B", "foo bar")])
    scope = spark.createDataFrame([("foo bar", "B")], "pattern string, tinyId string")
    assert [r.tinyId for r in dc.discover(t, scope.select("pattern"), scope).collect()] == ["B"]


def test_masking(spark):
    t = _t(spark, [("A", "taken as part of the Foo Bar Scale (FBS) today"), ("B", "Foo Bar Scale alone"), ("C", None)])
    assert [r.masked for r in dc.mask_after(t, ["Foo Bar Scale"]).collect()] == ["taken [MASK] today", "Foo Bar Scale alone", None]
    seqs = dc.mask_spans(mining.sequences(t.where("text is not null")), spark.createDataFrame([("Foo Bar",), ("",), (None,)], "name string"))
    assert {r.tinyId: [w for w, f in zip(r.tokens, r.free) if f] for r in seqs.collect()}["B"] == ["scale", "alone"]


def test_prune(spark):
    p = spark.createDataFrame([("f", "a b c", "1"), ("f", "a b", "1"), ("f", "a b", "2"), ("g", "a b", "1")], "field string, phrase string, tinyId string")
    key = lambda df: {(r.field, r.phrase, r.tinyId) for r in df.collect()}
    assert key(dc.prune(p)) == {("f", "a b c", "1"), ("g", "a b", "1")}
    assert key(dc.prune(p, "tinyid")) == {("f", "a b c", "1"), ("f", "a b", "2"), ("g", "a b", "1")}
    assert key(dc.prune(p, "threshold")) == {("f", "a b", "1"), ("f", "a b", "2")}
    assert key(dc.prune(p, "none")) == key(p)


def test_splits_and_strip_patterns(spark):
    names = spark.createDataFrame([("Foo Bar Test - Sleep Part (FBT)",), ("Scale - of pain",), ("Drop me",)], "name string")
    s = {r.name: (r["full"], r.sub, r.abbreviation) for r in dc.splits(names).collect()}
    assert s["Foo Bar Test - Sleep Part (FBT)"] == ("Foo Bar Test", "Sleep Part", "FBT") and s["Scale - of pain"] == ("Scale - of pain", None, None)
    dec = spark.createDataFrame([("Drop me", "skip", None), ("Scale - of pain", "modify", "Pain (x) scale")], "name string, decision string, modification string")
    got = {r.pattern for r in dc.strip_patterns(dc.splits(names), dec).collect()}
    assert got == {"Foo Bar Test", r"REGEX:\bSleep Part\b", r"REGEX:\bFBT\b", "Pain (x) scale"}


def test_batches_survive_a_bad_client(spark):
    p = spark.createDataFrame([(f"p{i}", "past" if i % 2 else "x") for i in range(5)], "phrase_id string, text string")
    good = dc.classify_batches(p, dc.keyword_client({"t": "past"}, "o"), ["t", "o"], batch=2).collect()
    assert {r.phrase_id: r.category for r in good}["p1"] == "t" and len(good) == 5

    def broken(texts):
        raise RuntimeError("down")

    assert {r.confidence for r in dc.classify_batches(p, broken, ["t"]).collect()} == {0.0}
    assert {r.confidence for r in dc.classify_batches(p, lambda t: [{"category": "zzz", "confidence": 1.0}], ["t"]).collect()} == {0.0}


def test_exports_and_suggestions(spark):
    e = spark.createDataFrame([("A", "x", "instrument", 0.9, None), ("B", "x", "instrument", 0.5, None), ("C", "x", "medical_term", 0.9, None), ("D", "x", "study", 0.9, "skip")], "abbreviation string, expansion string, category string, confidence double, decision string")
    assert {r.abbreviation: r.target for r in dc.export_abbreviations(e).collect()} == {"A": "strip", "B": "review", "C": "skip", "D": "skip"}
    m = spark.createDataFrame([("In the past year",), ("in the  past week",), ("other",)], "text string")
    r = dc.suggest(m).first()
    assert (r.prefix, r.n) == ("in the past", 2) and re.search(r.regex, "IN THE-past")


def test_lemmas(spark):
    df = spark.createDataFrame([(w,) for w in ("studies", "scales", "classes", "stress", "boxes", "children", "was", "it")], "w string")
    assert [r.l for r in df.select(dc.lemma(F.col("w")).alias("l")).collect()] == ["study", "scale", "class", "stress", "box", "child", "be", "it"]


@pytest.mark.parametrize(("make", "given_", "some"), [(pt.plural_variants, "rating scale", "rating scales"), (pt.number_variants, "past 7 days", "past seven days"), (pt.temporal_variants, "in the past year", "over the last year"), (pt.punctuation_variants, "foo:", "foo - "), (pt.spacing_variants, "self-report", "self report"), (pt.case_variants, "a b", "A B")])
def test_generators(make, given_, some):
    out = make(given_)
    assert given_ in out and some in out


def test_extended_spans_and_reference_text(spark):
    df = spark.createDataFrame([('see ("the score").', [("doc", "t"), ("", "u"), (None, None)])], "t string, d array<struct<document:string,text:string>>")
    r = df.select(dc.extend_span(F.col("t"), F.lit(6), F.lit(15)).alias("s"), dc.reference_text(F.col("d")).alias("d")).first()
    assert r.s == '("the score").' and r.d == "doc;; u"
