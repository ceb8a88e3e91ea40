"""Core operators on small inputs: paths, filters, aggregates, mining, matching, stripping, curation."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from textlens.functions import paths, text as tx
from textlens.operators import aggregates as ag, curation as cu, discovery as dc, encoding as en, fields, filters, grouping as gr, instruments as ins, ledger as lg, matching as mt, mining, patterns as pt, stripping as sp, verbatim as vb


def _texts(spark, rows):
    return spark.createDataFrame([(i, f, p, t) for i, f, p, t in rows], "tinyId string, field string, field_path string, text string")


def _simple(spark, pairs):
    return _texts(spark, [(i, "definition", f"definitions[{n}].definition", t) for n, (i, t) in enumerate(pairs)])


def test_text_functions(spark):
    df = spark.createDataFrame([("  a\r\n\nb  c ",), (None,), ("“naïve” – ½ø​",), ("12",), ("1.50",), ("word",)], "t string")
    got = [tuple(r) for r in df.select(tx.sanitize(F.col("t")), tx.value_type(F.col("t")), tx.slug(F.col("t"))).collect()]
    assert got[0][0] == "a b c" and got[1][0] == "" and got[2][0] == '"naive" - 1/2o'
    assert [g[1] for g in got] == ["str", "null", "str", "int", "float", "str10"] or got[3][1] == "int"
    assert got[5][2] == "word"


def test_paths(spark):
    df = spark.createDataFrame([([("x", ["t1", None]), ("y", None)], ("n",))], "d array<struct<a:string,tags:array<string>>>, s struct<n:string>")
    r = df.select(paths.get(df, "d.*.a").alias("a"), paths.get(df, "d.0.a").alias("b"), paths.get(df, "d.*.tags.*").alias("c"), paths.get(df, "s.n").alias("d"), paths.get(df, "d.7.a").alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (["x", "y"], "x", ["t1"], "n", None)
    up = df.select(paths.put(df, "d.*.a", F.upper).alias("d")).first().d
    assert [x.a for x in up] == ["X", "Y"] and up[0].tags == ["t1", None]
    leaf = {(x.path, x.value) for x in df.select(paths.leaves(df).alias("l")).first().l}
    assert ("d.*.a", "x") in leaf and ("d.*.tags", None) in leaf and ("s.n", "n") in leaf
    with pytest.raises(ValueError):
        paths.get(df, "s.none")


def test_name_question_and_fallback(spark):
    d = "array<struct<designation:string,tags:array<string>>>"
    df = spark.createDataFrame([([("n", ["Long Name"]), ("q", ["Preferred Question Text"])],), ([("first", None), ("second", [])],), ([],), (None,)], f"d {d}")
    assert [tuple(r.x) for r in df.select(fields.name_and_question(F.col("d")).alias("x")).collect()] == [("n", "q"), ("first", "second"), (None, None), (None, None)]


def test_logic_grammar(spark):
    flags = {"a": F.lit(True), "b": F.lit(False)}
    value = lambda e: spark.range(1).select(filters.Logic(e).column(flags)).first()[0]
    assert value("a and not b") and not value("b or (b and a)") and not value("a and missing")
    for bad in ("a and", "__import__('os')", "a b", "(a"):
        with pytest.raises(ValueError):
            value(bad)


def test_kmers_masking_and_mining(spark):
    t = _simple(spark, [("A", "one two three four five"), ("B", "one two three four five"), ("C", "two three four"), ("D", "x")])
    k3 = {r.kmer: (r.freq, r.n_ids) for r in mining.count_kmers(mining.sequences(t), 3, 2, 2).collect()}
    assert k3 == {"one two three": (2, 2), "two three four": (3, 3), "three four five": (2, 2)}
    got = {(r.phrase, r.k, r.freq, r.n_ids) for r in mining.mine(t, 5, 3, 2, 2).collect()}
    assert got == {("one two three four five", 5, 2, 2)}
    masked = mining.mask(mining.sequences(t), spark.createDataFrame([("two three",)], "kmer string"), 2)
    assert {tuple(r.free) for r in masked.where("tinyId = 'A'").collect()} == {(True, False, False, True, True)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), min_size=2, max_size=5))
def test_mine_equals_single_threaded_model(spark, seqs):
    free = [[True] * len(s) for s in seqs]
    want = set()
    for k in range(6, 1, -1):
        n, ids = Counter(), defaultdict(set)
        at = defaultdict(list)
        for i, s in enumerate(seqs):
            for p in range(len(s) - k + 1):
                if all(free[i][p : p + k]):
                    w = " ".join(s[p : p + k])
                    n[w] += 1
                    ids[w].add(i)
                    at[i].append((p, w))
        good = {w for w in n if n[w] >= 2 and len(ids[w]) >= 2}
        want |= {(w, n[w], len(ids[w])) for w in good}
        for i, hits in at.items():
            end = 0
            for p, w in hits:
                if w in good and p >= end:
                    free[i][p : p + k] = [False] * k
                    end = p + k
    t = _simple(spark, [(f"r{i}", " ".join(s)) for i, s in enumerate(seqs)])
    assert {(r.phrase, r.freq, r.n_ids) for r in mining.mine(t, 6, 2, 2, 2).collect()} == want


def test_subsume_needs_kept_container_and_shared_ids(spark):
    p = spark.createDataFrame([("a b c d",), ("a b c",), ("b c",), ("x y",)], "phrase string")
    ids = spark.createDataFrame([("a b c d", "1"), ("a b c", "1"), ("b c", "2"), ("x y", "1")], "phrase string, tinyId string")
    assert {r.phrase for r in mining.subsume(p, ids).collect()} == {"a b c d", "b c", "x y"}


def test_literal_hits_equal_nested_loop(spark):
    t = _simple(spark, [("A", "Foo barbaz qux"), ("B", "xfoo bar bazy"), ("C", "the end"), ("D", "alpha beta gamma delta")])
    pats = ["foo bar", "bar baz", "e", "beta gamma", "alpha beta gamma", "nothing here at all", "he en"]
    want = {(p, r.tinyId) for p in pats for r in t.collect() if p in r.text.lower()}
    for most in (100, 3):  # by automaton, by join
        got = {(r.pattern, r.tinyId) for r in mt.literal_hits(t, spark.createDataFrame([(p,) for p in pats], "pattern string"), most=most).collect()}
        assert got == want


def test_strip_orders_and_scopes(spark):
    t = _simple(spark, [("A", "ab abc x"), ("B", "ab abc x")])
    uni = spark.createDataFrame([(1, "ab", "")], "ord int, phrase string, replace_with string")
    own = spark.createDataFrame([("A", 0, "abc", "Q")], "tinyId string, ord int, phrase string, replace_with string")
    got = {r.tinyId: r.stripped for r in sp.strip(t, uni, own).collect()}
    assert got == {"A": " c x", "B": " c x"}  # universal first: nothing is left for the scoped one
    got = {r.tinyId: r.stripped for r in sp.strip(t, uni, own, one_order=True).collect()}
    assert got == {"A": " Q x", "B": " c x"}


def test_inject_and_reverse(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("text is not null").select(F.col("doc_id").cast("string").alias("tinyId"), F.lit("definition").alias("field"), F.lit("p").alias("field_path"), "text")
    planted = docs.withColumn("clean", F.col("text")).withColumn("text", F.concat(F.substring("text", 1, 40), F.lit("<<planted marker>>"), F.substring("text", F.lit(41), F.length("text"))))
    rules = spark.createDataFrame([(0, "<<planted marker>>", "")], "ord int, phrase string, replace_with string")
    assert sp.strip(planted, rules).where("stripped <> clean").count() == 0


def test_seven_variants_are_distinct(spark):
    t = _simple(spark, [("A", "FULL SUB TEMP PHR rest")])
    row = sp.variants(t, {"inst_full": [("FULL", "")], "inst_sub": [("SUB", "")], "temporal": [("TEMP", "")], "phrase": [("PHR", "")]}).first()
    assert len({row[c] for c in sp.STAGES}) == 7
    same = sp.variants(t, {"inst_full": [("FULL", "")], "inst_sub": [("FULL", "")]}).first()
    assert same.MTSFPF == same.MFSTPF == same.MTSTPF


@pytest.mark.parametrize(("text", "kind"), [("Score from the", "trailing_article"), ("Total score the,", "orphan_article"), ("a () b", "empty_parens"), ("pain as part of the", "orphan_anchor"), ("x , y", "floating_punct"), ("the patient 's arm", "dangling_s")])
def test_remnants(spark, text, kind):
    assert kind in {r.remnant_type for r in sp.remnants(_simple(spark, [("A", text)])).collect()}


@pytest.mark.parametrize(("text", "want"), [("foo, as part of the .", "foo"), ("foo , bar", "foo bar"), ("the, foo", "foo"), ("foo of the", "foo"), ("x,, b", "x, b"), ("  x  ()  y ", "x y"), ("", "")])
def test_clean(spark, text, want):
    assert sp.clean(spark.createDataFrame([(text,)], "t string"), "t").first().t == want


def test_html(spark):
    t = "<p>A&nbsp;B</p><table><tr><th>h</th></tr><tr><td>1</td><td>2</td></tr></table>"
    r = spark.createDataFrame([(t,)], "t string").select(sp.html_text(F.col("t")).alias("p"), sp.html_tables(F.col("t")).alias("x")).first()
    assert r.p == "A B h 1 2" and r.x == [[["h"], ["1", "2"]]]


@pytest.mark.parametrize(
    ("pattern", "yes", "no"),
    [
        ("as part of the Neuro-QOL", ["as  part of Neuro QOL", "As part of the NeuroQOL."], ["aspart of NeuroQOL"]),
        ("Risk Factor Questionnaire (RFQ)", ["risk factor questionnaire(RFQ)"], ["Risk Factor Questionnaires (RFQ)"]),
        ("Scale version 2", ["scale version 2.0", "Scale version 2"], ["scale version 23", "euthanasiascale version 2"]),
    ],
)
def test_flexible_regex(pattern, yes, no):
    import re

    rx = re.compile(pt.flexible_regex(pattern), re.I)
    assert all(rx.search(y) for y in yes) and not any(rx.search(n) for n in no)


def test_coalesce_keeps_prefixes_and_drops_covered(spark):
    rows = [("in the past 7 days:", "A"), ("in the past 7 days:", "B"), ("in the past 7 days", "A"), ("in the past 7 days", "B"), ("please answer the following", "A"), ("please answer the following", "B"), ("the following", "A")]
    got = {r.pattern: r.status for r in pt.coalesce(spark.createDataFrame(rows, "pattern string, tinyId string")).collect()}
    assert got == {"in the past 7 days:": "kept", "in the past 7 days": "kept", "please answer the following": "kept", "the following": "subsumed"}


@pytest.mark.parametrize("seed", [4, 5])
def test_greedy_cover_equals_sequential_rule(spark, seed):
    rnd = random.Random(seed)
    groups = {f"g{i}": (rnd.randint(2, 4), {rnd.randint(0, 12) for _ in range(rnd.randint(1, 6))}) for i in range(14)}
    left, want, stay = set(range(13)), [], []
    for g, (k, m) in sorted(groups.items(), key=lambda x: (-x[1][0], -len(x[1][1]), x[0])):
        new = m & left
        if len(new) >= 2:
            want.append((g, len(new)))
            left -= new
        elif len(m) >= 2 and k >= 4:
            stay.append((g, 0))
    df = spark.createDataFrame([(g, k, str(x)) for g, (k, m) in groups.items() for x in m], "`group` string, k int, member string")
    assert sorted((r.group, r.n_new) for r in pt.greedy_cover(df).collect()) == sorted(want)
    assert sorted((r.group, r.n_new) for r in pt.greedy_cover(df, long_from=4).collect()) == sorted(want + stay)


def test_guarded_groups_and_ids_in_the_cover(spark):
    rnd = random.Random(9)
    rows = [(f"g{g}", rnd.randint(2, 4), rnd.randint(1, 3), f"m{m}", rnd.random() < 0.15) for g in range(9) for m in rnd.sample(range(10), 4)]
    spec = {r[0]: (r[1], r[2]) for r in rows}
    rows = [(g, *spec[g], m, x) for g, _, _, m, x in rows]
    ids = [(f"m{m}", f"i{rnd.randint(0, 6)}") for m in range(10) for _ in range(2)]
    taken, of = {}, defaultdict(set)
    for m, i in ids:
        of[m].add(i)
    for g in sorted(spec, key=lambda g: (-spec[g][0], -spec[g][1], g)):
        new = {m: x for h, _, _, m, x in rows if h == g and m not in taken}
        if len(new) >= 2 and not any(new.values()) and len(set().union(*(of[m] for m in new))) >= 3:
            taken |= {m: g for m in new}
    got = pt.greedy_members(spark.createDataFrame(rows, "`group` string, k int, weight int, member string, guarded boolean"), 2, spark.createDataFrame(ids, "member string, id string").distinct(), 3)
    assert {r.member: r.group for r in got.collect()} == taken


def _coalesced(spark, rows, parents=None, **how):
    ids = spark.createDataFrame([(p, i) for p, some in rows for i in some or [None]], "pattern string, tinyId string")
    if parents is not None:
        parents = spark.createDataFrame(parents, "pattern string, parent_phrase string, parent_tinyid_count int")
    return {r.pattern: r for r in pt.coalesce(ids, parents, **how).collect()}


def test_coalesce_trims_anchors_anywhere(spark):
    got = _coalesced(spark, [("as part of the Neuro Test", "AB"), ("total score, based on Neuro Test", "C"), ("as part of version 2.0 of 12-item SF", "A"), ("from", "A")])
    assert {p: r.n_ids for p, r in got.items()} == {"Neuro Test": 3, "12-item SF": 1, "from": 1}


def test_coalesce_rolls_down_and_up(spark):
    rows = [("Berg Balance Scale", "ABC"), ("Berg Balance Scale, a clinical test", "AB"), ("Berg Balance Scale General Satisfaction", "AB"), ("Berg Balance Scale (BBS) -", "A"), ("Scale", "ABC")]
    plain, rolled = _coalesced(spark, rows), _coalesced(spark, rows, roll=True)
    assert {r.status for p, r in plain.items() if p != "Scale"} == {"kept"} and plain["Scale"].status == "subsumed"
    assert (rolled["Berg Balance Scale, a clinical test"].status, rolled["Berg Balance Scale, a clinical test"].replacement) == ("rolled-down", "Berg Balance Scale")
    assert rolled["Berg Balance Scale General Satisfaction"].status == "kept" == rolled["Berg Balance Scale (BBS) -"].status
    short = _coalesced(spark, [("in the past 7 days:", "AB"), ("in the past 7 days: or so", "AB")], roll=True)
    assert {p: r.status for p, r in short.items()} == {"in the past 7 days:": "kept", "in the past 7 days: or so": "rolled-down"}
    up = _coalesced(spark, [("Health Index", "A"), ("Health Index Total Score", "AB")], roll=True)
    assert up["Health Index"].status == "rolled-up" and up["Health Index"].replacement == "Health Index Total Score"
    assert {r.status for r in _coalesced(spark, [("x y", ""), ("x y z", "A")], roll=True).values()} == {"kept"}  # universal: within nothing smaller


def test_coalesce_extracts_prefixes_and_definition_forms(spark):
    rows = [("Mood Scale total.", "A"), ("Mood Scale part", "B"), ("Mood Scale, raw", "C"), ("Sleep Index (SI) -", "A"), ("Sleep Index night", "B")]
    got = _coalesced(spark, rows, least_prefix_ids=2, definition_forms=True)
    assert {p for p, r in got.items() if r.status == "kept"} == {"Mood Scale", "Sleep Index (SI) -", "Sleep Index (SI)", "Sleep Index night"}
    assert got["Mood Scale"].n_ids == 3 and got["Mood Scale part"].status == "prefix" and got["Mood Scale part"].replacement == "Mood Scale"
    assert got["Sleep Index (SI)"].group_key == "Sleep Index (SI" or got["Sleep Index (SI)"].group_key == "Sleep Index (SI)"
    assert got["Sleep Index night"].group_key == "Sleep Index"


def test_coalesce_filters_by_parents(spark):
    rows, parents = [("Mood Scale total", "A"), ("Mood Scale part", "B"), ("other name", "ABC"), ("rare name", "A")], [("Mood Scale total", "p", 1), ("Mood Scale part", "p", 1), ("other name", "q", 1), ("rare name", "r", 9)]
    now = {p: r.status for p, r in _coalesced(spark, rows, parents, least_parent_ids=2, least_actual_ids=3).items()}
    assert now == {"Mood Scale total": "parent-filtered", "Mood Scale part": "parent-filtered", "other name": "kept", "rare name": "kept"}
    late = {p: r.status for p, r in _coalesced(spark, rows, parents, least_parent_ids=2, least_prefix_ids=2, defer=True).items()}
    assert late == {"Mood Scale total": "prefix", "Mood Scale part": "prefix", "Mood Scale": "kept", "other name": "parent-filtered", "rare name": "kept"}


def test_core_names():
    rx = re.compile(pt.core_regex("12-item Short Form Health Survey (SF-12)"), re.I)
    for t in ("12-item short form health survey", "12 item Short Form Health Survey (SF-12v2)", "12-item Short Form Health Survey Version 2 (SF-12)", "12-item Short  Form Health Survey v2.0."):
        assert rx.search(t), t
    assert not rx.fullmatch("12-item Short Form Health Survey (ABC)") and not rx.search("Short Form Health Survey")


def test_kappa_alpha_consensus(spark):
    rows = [("i1", "a", "strip"), ("i1", "b", "strip"), ("i2", "a", "skip"), ("i2", "b", "strip"), ("i3", "a", "skip"), ("i3", "b", "skip"), ("i4", "a", "modify")]
    df = spark.createDataFrame(rows, "item string, rater string, label string")
    k = cu.cohens_kappa(df).first()
    assert (k.n_items, k.n_agree, k.observed) == (3, 2, 0.6667) and math.isclose(k.kappa, 0.4, abs_tol=1e-4)
    assert {r.item: (r.consensus, r.agreement) for r in cu.consensus(df).collect()} == {"i1": ("strip", "unanimous"), "i2": ("strip", "split"), "i3": ("skip", "unanimous"), "i4": ("modify", "single")}
    assert cu.krippendorff_alpha(df.where("item = 'i1'")).first().alpha is None
    assert math.isclose(cu.krippendorff_alpha(df).first().alpha, 1 - (1 - 4 / 6) / (1 - (3 * 2 + 3 * 2) / 30), abs_tol=1e-4)


def test_ledger(spark):
    cur = spark.createDataFrame([("s",), ("k",), ("k2",), ("new",)], "pattern string")
    led = spark.createDataFrame([("s", "strip", None), ("k", "skip", None), ("k2", "modify", "m")], "pattern string, decision string, modification string")
    ids = spark.createDataFrame([("s", "9"), ("k", "9"), ("k2", "1")], "pattern string, tinyId string")
    old = spark.createDataFrame([("k", "1"), ("k2", "1")], "pattern string, tinyId string")
    assert {r.pattern: r.status for r in cu.classify(cur, ids, led, old).collect()} == {"s": "auto_strip", "k": "review_changed_skip", "k2": "auto_modify", "new": "review_new"}


def test_instrument_mentions(spark):
    t = _simple(spark, [("A", "taken as part of the Drug Abuse Screening Test (DAST) battery."), ("B", "as part of the daily routine we do")])
    assert [(r.instrument_name, r.acronym) for r in ins.mentions(t).collect()] == [("Drug Abuse Screening Test", "DAST")]


def test_acronyms(spark):
    t = _simple(spark, [("A", "The Patient Health Questionnaire (PHQ) is a self-report measure.")])
    r = ins.parenthetical(t).first()
    assert (r.abbreviation, r.expansion, r.confidence) == ("PHQ", "Patient Health Questionnaire", 0.95)
    tails = [("measured by the Epstein-Barr virus", "EBV", "Epstein-Barr virus"), ("a b c", "XYZ", "a b c"), ("of Pain, of Sleep", "OS", "Sleep"), ("Health Health Questionnaire", "HQ", "Health Questionnaire"), ("", "A", ""), ("2 days", "", "2 days")]
    got = spark.createDataFrame([(i, *t) for i, t in enumerate(tails)], "i int, t string, a string, want string").select("want", ins.aligned(F.col("t"), F.col("a")).alias("x"))
    assert all(r.x == r.want for r in got.collect())
    assert ins.variant_type("Beck Inventry", "Beck Inventory") == "deletion" and ins.variant_type("BECK", "Beck") == "case"


def test_verbatim():
    assert vb.assembled(["in the past seven", "past seven days or so", "x"], 5) == [("in the past seven days or so", [0, 1]), ("x", [2])]
    assert [t for t, _ in vb.assembled(["Cde efgh", "efgh ab", "ABCDE"], 3)] == ["ABCDE efgh ab"] and vb.assembled([], 3) == []
    ring = [t for t, _ in vb.assembled(["abcxyz", "xyzabc"], 3)]
    assert ring in (["abcxyzabc"], ["xyzabcxyz"])
    assert vb.template(["hello"], 3)["regex"] == "hello" and vb.slot(["hello", ""]) == "(hello)?"
    assert vb.common_core(["the past 7 days", "in the Past 7 days:"]) == "the past 7 days"
    assert vb.difference("past 7", "in the past 7 days") == ("in the ", " days", "contained")


def test_verbatim_forms_are_refined(spark):
    one, two, both = frozenset("A"), frozenset("B"), frozenset("AB")
    assert vb.refined([("harmful and usually", 2, one), ("And usually subject to", 3, one)]) == [("harmful and usually subject to", 5, one)]
    assert vb.refined([("the past seven days", 4, both), ("past seven", 9, one)]) == [("the past seven days", 4, both)]  # shares a record: goes
    assert vb.refined([("the past seven days", 4, one), ("past seven", 9, two)]) == [("the past seven days", 13, both)]  # other records: joins
    assert vb.refined([("the past seven days", 4, one), ("ast seven", 9, two)]) == [("the past seven days", 4, one), ("ast seven", 9, two)]
    assert vb.refined([("short form health survey of all", 1, one), ("short form health surv", 2, two)]) == [("short form health survey of all", 3, both)]
    assert vb.refined([("Pain", 1, one), ("pain", 2, one), ("PAIN", 4, two)]) == [("PAIN", 4, two), ("Pain", 3, one)]
    rows = [("p", "the past  seven days", "A"), ("p", "past seven", "B"), ("p", "past seven", "C"), ("p", "past seven", "C"), ("q", "x", "A"), ("q", None, "A"), (None, "x", "A"), ("q", "y", None), ("q", " ", "A")]
    df = spark.createDataFrame(rows, "phrase_id string, verbatim_text string, tinyId string").withColumn("form", F.lit("clash"))
    assert {tuple(r) for r in vb.refine(df).collect()} == {("p", "the past seven days", 4, 3), ("q", "x", 1, 1)}
    assert vb.refine(df.limit(0)).count() == 0


def test_contigs(spark):
    k = spark.createDataFrame([("a b c", 5), ("b c d", 4), ("c d e", 6), ("x y z", 3)], "kmer string, freq bigint")
    assert {(r.phrase, r.freq) for r in gr.contigs(k).collect()} == {("a b c d e", 4), ("x y z", 3)}
    ring = spark.createDataFrame([("a b", 1), ("b a", 1)], "kmer string, freq bigint")
    assert {r.phrase for r in gr.contigs(ring).collect()} == {"a b", "b a"}


def test_encoding_round_trip(spark):
    t = _simple(spark, [("A", "one two"), ("A", "two three")])
    ranks = ag.vocabulary(t, 1)
    coded = en.encode(t, ranks).select("codes", en.to_base85(F.col("codes")).alias("x")).first()
    assert en.from_base85(coded.x) == coded.codes and len(coded.codes) == 4


def test_empty_inputs(spark):
    t = _simple(spark, [("A", "x")]).limit(0)
    p = spark.createDataFrame([], "pattern string")
    for df in (ag.duplicate_texts(t), mining.mine(t), mt.literal_hits(t, p), ins.mentions(t), vb.templates(spark.createDataFrame([], "phrase_id string, verbatim_text string")), mt.leakage(t, {"a": "b"})):
        assert df.count() == 0


def test_strip_lists_equal_the_rules_one_after_the_other(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("ab ") for _ in range(rnd.randint(1, n)))
    rules = {s: [(i, word(4), rnd.choice(["", "b", "ab"]), rnd.choice([[], ["r1"], ["r1", "r2"]])) for i in range(30)] for s in "xy"}
    rows = [(f"r{i % 3}", f"p{i}", word(30)) for i in range(60)]

    def fold(key, t, stage):
        for i, p, r, ids in sorted(rules[stage], key=lambda x: (x[3] != [], -len(x[1]), x[0])):
            t = t.replace(p, r) if not ids or key in ids else t
        return t

    lists = {s: spark.createDataFrame(v, "file_ord int, phrase string, replace_with string, ids array<string>") for s, v in rules.items()}
    got = sp.strip_lists(spark.createDataFrame(rows, "tinyId string, field_path string, text string"), lists, {"a": ("x",), "b": ("x", "y")}).collect()
    want = {f: (fold(k, t, "x"), fold(k, fold(k, t, "x"), "y")) for k, f, t in rows}
    assert len(got) == 60 and {r.field_path: (r.a, r.b) for r in got} == want


def test_lists_in_parts_equal_the_rules_one_after_the_other(spark, monkeypatch):
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("ab ") for _ in range(rnd.randint(1, n)))
    rules = {s: [(rnd.choice([i, i, None]), word(5), rnd.choice(["", "b", "ab", None]), rnd.choice([[], ["r1"], ["r1", "r2"]])) for i in range(16)] for s in "xyz"}
    rows = [(f"r{i % 3}", f"p{i}", word(40)) for i in range(60)] + [("r1", "none", None), (None, "p", "ab ab")]
    lists = {s: spark.createDataFrame(v, "file_ord int, phrase string, replace_with string, ids array<string>") for s, v in rules.items()} | {"empty": spark.createDataFrame([], "file_ord int, phrase string, replace_with string, ids array<string>")}
    texts = spark.createDataFrame(rows, "tinyId string, field_path string, text string")
    plan = {"a": ("x",), "b": ("x", "y"), "c": ("z", "x"), "d": ("empty", "x", "y", "z"), "e": ()}
    whole = sorted(map(str, sp.strip_lists(texts, lists, plan).collect()))
    monkeypatch.setattr(sp, "PART", 60)  # parts of about five rules, two of them at once
    monkeypatch.setattr(sp, "HELD", 120)
    assert sorted(map(str, sp.strip_lists(texts, lists, plan).collect())) == whole


def _longer_lists(spark, small, tmp_path, idle):
    """The tables of the stripping queries with a last rule that changes most texts, and as many rules as asked that occur nowhere."""
    for name in ("cde_item", "phrases", "inst_full_patterns"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{small}/{name}.parquet")
    s = spark.read.parquet(f"{small}/substitute_patterns.parquet")
    blank = {c: F.lit(None).cast(t) for c, t in s.dtypes} | {"replace_with": F.lit("#")}
    last = spark.range(1).select((F.col("id") + 9_000_000).alias("row_id"), F.lit("e").alias("pattern"))
    more = spark.range(idle).select((F.col("id") + 1_000_000).alias("row_id"), F.concat(F.lit("~"), "id", F.repeat(F.lit("~"), (F.col("id") % 90).cast("int"))).alias("pattern"))
    added = last.unionByName(more).withColumns({c: x for c, x in blank.items() if c not in ("row_id", "pattern")}).select(s.columns)
    s.unionByName(added).write.parquet(str(tmp_path / "substitute_patterns.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["clean_text", "strip_literal_ordered", "remnant_report", "production_strip"])
def test_lists_over_50_000_rules_are_applied_whole(spark, small, tmp_path, name):
    from textlens.plans import q_groups, q_matching

    query = (q_matching.QUERIES | q_groups.QUERIES)[name]
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    want, got = (sorted(map(str, query(spark, _longer_lists(spark, small, tmp_path / d, idle)).collect())) for d, idle in (("a", 1), ("b", 50_100)))
    assert got == want and any("#" in r for r in got) == (name not in ("production_strip",))


def test_long_universal_lists_equal_the_fold(spark, monkeypatch):
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, n)))
    uni = spark.createDataFrame([(rnd.choice([None, *range(9)]), word(4) or "a", rnd.choice(["", "b", "bb", None])) for _ in range(60)], "ord int, phrase string, replace_with string")
    own = spark.createDataFrame([(f"r{rnd.randint(0, 2)}", rnd.choice([None, *range(9)]), word(4) or "b", rnd.choice(["", "a"])) for _ in range(40)], "tinyId string, ord int, phrase string, replace_with string")
    own = own.unionByName(own.limit(5))  # the same rule twice counts twice
    texts = spark.createDataFrame([(f"r{i % 4}", f"p{i}", word(25)) for i in range(50)] + [("r1", "none", None)], "tinyId string, field_path string, text string")
    cases = [{}, {"scoped": own}, {"scoped": own, "one_order": True}]
    done = lambda: [sorted(map(str, sp.strip(texts, uni, **c).collect())) for c in cases]
    want = done()
    monkeypatch.setattr(sp, "SHORT", 5)
    monkeypatch.setattr(sp, "PART", 100)
    assert done() == want


def test_production_strip_reads_the_pattern_tables(spark, small):
    from textlens.plans import corpus

    own = corpus.pattern_lists(spark, small)["substitute"].where("size(ids) > 0 and phrase <> ''").orderBy("file_ord").first()
    texts = spark.createDataFrame([(own.ids[0], "a", f"x {own.phrase} y"), ("nobody", "a", f"x {own.phrase} y"), ("nobody", "b", "Within the previous 7 days pain")], "tinyId string, field_path string, text string")
    from textlens.plans.workflow import production_strip

    tables = production_strip(corpus.pattern_lists(spark, small), gr.TEMPORAL_SEEDS).run(spark, {"texts": texts})["tables"]
    done = {(r.tinyId, r.field_path): r.text for r in tables["substitute"].collect()}
    assert own.phrase not in done[own.ids[0], "a"] and done["nobody", "a"] == f"x {own.phrase} y"
    assert {r.MFSFPT for r in tables["branch"].where("field_path = 'b'").collect()} == {" pain"}


def test_production_strip_cleans_every_variant(spark, small):
    from textlens.plans import corpus
    from textlens.plans.workflow import production_strip

    lists = {stage: corpus.with_rules(df, [(w, "")]) for (stage, df), w in zip(corpus.pattern_lists(spark, small).items(), ["zz", "full", "sub", "phrase"])}
    rows = [("a", "definitions[0].definition", "full sub phrase , the"), ("a", "definitions[1].definition", "nothing  here"), ("b", "designations[0].designation", "full")]
    tables = production_strip(lists, gr.TEMPORAL_SEEDS).run(spark, {"texts": spark.createDataFrame(rows, "tinyId string, field_path string, text string")})["tables"]
    got = sorted((r.tinyId, r.field_path, r.variant, r.text) for r in tables["clean"].collect())
    one = lambda v: sp.clean(tables["branch"].select("tinyId", "field_path", F.col(v).alias("text")), "text", passes=5).collect()
    assert got == sorted((r.tinyId, r.field_path, v, r.text) for v in sp.STAGES for r in one(v)) and len(got) == 21 and len({g[3] for g in got}) > 5


def test_mine_phrases_finds_phrases_of_25_tokens(spark, monkeypatch):
    from textlens.plans import q_mining

    long = " ".join(f"w{i}" for i in range(25))
    monkeypatch.setattr(q_mining, "texts", lambda spark, d: _simple(spark, [("a", long), ("b", long), ("c", long)]))
    assert [(r.phrase, r.k, r.freq, r.n_ids) for r in q_mining.QUERIES["mine_phrases"](spark, "").collect()] == [(long, 25, 3, 3)]


def test_longest_and_merged_phrases(spark):
    k = spark.createDataFrame([("a b c", 5), ("b c d", 5), ("c d e", 5), ("b c x", 5), ("a b c", 3), ("p q", 5), ("q p", 5)], "kmer string, count int")
    got = {(r.phrase, r.k, r["count"]) for r in gr.longest_phrases(k).collect()}
    assert got == {("a b c d e", 5, 5), ("b c x", 3, 5), ("a b c", 3, 3), ("p q", 2, 5), ("q p", 2, 5)}
    ids = spark.createDataFrame([("a b c", "1"), ("b c d", "2"), ("c d e", "2"), ("b c x", "9")], "phrase string, tinyId string")
    assert {(r.phrase, r["count"]): r.n_ids for r in gr.longest_phrases(k, ids).collect()}["a b c d e", 5] == 2
    p = spark.createDataFrame([("in the past seven", 4), ("past seven days", 4), ("days or so", 4), ("days at most", 4), ("x", 4), ("seven days", 9), ("x y x", 4)], "phrase string, count int")
    got = {(r.phrase, r["count"]) for r in gr.merge_overlapping(p).collect()}
    assert got == {("in the past seven days at most", 4), ("days or so", 4), ("x", 4), ("seven days", 9), ("x y x", 4)}
    assert gr.merge_overlapping(p.limit(0)).count() == 0 and gr.longest_phrases(k.limit(0)).count() == 0


def test_chains_and_rings(spark):
    nodes = spark.createDataFrame([(f"n{i:02}",) for i in range(12)], "node string")
    links = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(8)] + [("n09", "n10"), ("n10", "n09")], "left string, right string")
    got = {r.node: (r.root, r.dist) for r in gr.chains(nodes, links).collect()}
    assert all(got[f"n{i:02}"] == ("n00", i) for i in range(9)) and got["n09"][0] is None and got["n10"][0] is None and got["n11"] == ("n11", 0)


def test_adjacent_prefix_over_partitions(spark):
    rnd = random.Random(2)
    names = sorted({" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(60)})
    want = {n: 0 if i == 0 else next((k for k in range(min(len(n.split()), len(names[i - 1].split()))) if n.split()[k] != names[i - 1].split()[k]), min(len(n.split()), len(names[i - 1].split()))) for i, n in enumerate(names)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.name: r.shared for r in gr.adjacent_prefix(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want


def test_mined_occurrences_equal_a_simple_model(spark):
    rnd = random.Random(5)
    base = ["the pain in the past seven days", "how often did you sleep well", "score of the scale"]
    rows = [(f"r{i % 7}", "definition", f"definitions[{i}].definition", " ".join(rnd.choice(base) for _ in range(rnd.randint(1, 3))) + rnd.choice([" Ünique", " x", ""])) for i in range(24)]
    seqs = {(r[0], r[2]): [w for w in re.findall(r"[^\W_]+", r[3].lower())] for r in rows}
    free = {k: [True] * len(t) for k, t in seqs.items()}
    want = {}
    for k in range(9, 2, -1):
        at = defaultdict(list)
        for key, t in seqs.items():
            for i in range(len(t) - k + 1):
                if all(free[key][i : i + k]):
                    at[tuple(t[i : i + k])].append((key, i))
        good = {p: w for p, w in at.items() if len(w) >= 3 and len({key[0] for key, _ in w}) >= 2}
        want |= {" ".join(p): sorted((*key, i, i + k) for key, i in w) for p, w in good.items()}
        starts = defaultdict(list)
        for w in good.values():
            for key, i in w:
                starts[key].append(i)
        for key, s in starts.items():
            last = -k
            for i in sorted(s):
                if i >= last + k:
                    free[key][i : i + k], last = [False] * k, i
    mined = mining.mine_occurrences(_texts(spark, rows), 9)
    names = {r.phrase_id: r.text for r in mined.phrases.collect()}
    got = defaultdict(list)
    for r in mined.occurrences.collect():
        got[names[r.phrase_id]].append((r.tinyId, r.field_path, r.token_start, r.token_end))
        whole = next(x[3] for x in rows if x[0] == r.tinyId and x[2] == r.field_path)
        assert r.verbatim_text in whole and " ".join(re.findall(r"[^\W_]+", r.verbatim_text.lower())) == names[r.phrase_id]
    assert {p: sorted(v) for p, v in got.items()} == want and want


def test_every_remnant_is_reported(spark):
    t = _simple(spark, [("A", "Score  from , the ; (  ) and the,"), ("B", "nothing to see"), ("C", None), ("D", "")])
    got = [(r.tinyId, r.remnant_type, r.position) for r in sp.remnants(t).collect()]
    want = []
    for name, p in sp.REMNANTS.items():
        want += [("A", name, m.start()) for m in re.finditer(p, "Score  from , the ; (  ) and the,", re.A)]
    assert sorted(got) == sorted(want) and len([x for x in got if x[1] == "floating_punct"]) == 2


def test_fields_are_cleaned_in_place(spark):
    df = spark.createDataFrame([("A", [("Score of the", "x"), (None, None)]), ("B", [("fine", "y")]), ("C", None)], "tinyId string, definitions array<struct<definition string, tag string>>")
    out, n = sp.clean_fields(df, ["definitions.*.definition"])
    assert {r.tinyId: r.definitions for r in out.collect()}["A"][0].definition == "Score" and out.schema == df.schema
    assert tuple(n.first()) == (3, 1)


def test_discovered_spellings_are_stripped_and_shown(spark):
    t = _simple(spark, [("A", "Rate it in the past  7 days, please."), ("B", "no such thing")])
    got = {r.tinyId: r for r in sp.discover_and_strip(t, spark.createDataFrame([("in the past 7 days",)], "pattern string")).withColumn("d", sp.line_diff(F.col("text"), F.col("stripped"))).collect()}
    assert got["A"].stripped == "Rate it , please." and got["B"].stripped == "no such thing" and got["B"].d == ""
    assert "-Rate it in the past  7 days, please." in got["A"].d and "+Rate it , please." in got["A"].d


def test_token_spans(spark):
    t = _texts(spark, [("A", "d", "p", "  The  Pain, scored (x)"), ("B", "d", "p", "")])
    s = spark.createDataFrame([("A", "p", 2, 11), ("A", "p", 8, 9), ("A", "p", 0, 2), ("A", "p", 22, 40), ("B", "p", 0, 5)], "tinyId string, field_path string, char_start int, char_end int")
    got = {(r.tinyId, r.char_start): (r.token_start, r.token_end) for r in ins.token_spans(t, s).collect()}
    assert got == {("A", 2): (0, 2), ("A", 8): (1, 2), ("A", 0): (None, None), ("A", 22): (None, None), ("B", 0): (None, None)}


def test_three_passes_and_abbreviations(spark):
    rows = [("A", "taken as part of the Drug Abuse Screening Test (DAST) battery."), ("B", "as part of the (DAST), again"), ("C", "the Mood Rating Sheet shown"), ("D", "based on (XYZ) only")]
    got = {(r.tinyId, r.instrument_name, r.source) for r in ins.three_passes(_simple(spark, rows), spark.createDataFrame([("Mood Rating Sheet", "MRS"), ("Drug Abuse Screening Test", "DAST")], "name string, acronym string")).collect()}
    assert got == {("A", "Drug Abuse Screening Test", "full"), ("B", "Drug Abuse Screening Test", "acronym"), ("C", "Mood Rating Sheet", "supplementary"), ("D", "[XYZ]", "acronym")}
    t = _simple(spark, [("A", "The Patient Health Questionnaire (PHQ) is short."), ("B", "score of PHQ"), ("C", "Rate now [ABC]")])
    e = {r.abbreviation: r for r in ins.abbreviation_pipeline(t, spark.createDataFrame([("ABC", "All Bad Cases Scale")], "acronym string, instrument_name string")).collect()}
    assert (e["PHQ"].expansion, e["PHQ"].category, e["PHQ"].source) == ("Patient Health Questionnaire", "instrument", "parenthetical")
    assert (e["ABC"].expansion, e["ABC"].expansion_source, e["ABC"].confidence) == ("All Bad Cases Scale", "catalog", 0.85)


def test_ledger_of_patterns_and_sections(spark):
    found = lambda rows: spark.createDataFrame(rows, "pattern string, ids array<string>, source string")
    empty = spark.createDataFrame([], "pattern string, ids array<string>, source string, first_round int, last_round int, status string")
    one = lg.update(empty, found([("a", ["2"], "x"), ("a", ["1"], "y"), ("b", None, "x")]), 1)
    two = {r.pattern: tuple(r) for r in lg.update(one, found([("a", ["3"], "z"), ("c", ["1"], "z")]), 2).collect()}
    assert two == {"a": ("a", ["1", "2", "3"], "x", 1, 2, "seen"), "b": ("b", [], "x", 1, 1, "new"), "c": ("c", ["1"], "z", 2, 2, "new")}
    h = spark.createDataFrame([("In the Past 7 days at least once", "new_candidate"), ("Mood Scale", "new_candidate"), ("x", "partial_match"), ("zzz", "new_candidate")], "phrase string, status string")
    assert {r.section: r.name for r in lg.to_sections(h).collect()} == {"temporal": "in_the_past_7_days", "instruments": "mood_scale", "other": "zzz"}


def test_answers_rates_and_prompts():
    cats = ["instrument", "temporal"]
    assert dc.answer_in('Sure! {"category": "Temporal", "confidence": 7, "reasoning": "r"} done', cats) == {"category": "temporal", "confidence": 1.0, "reasoning": "r"}
    assert dc.answer_in("It is an instrument.", cats)["category"] == "instrument" and dc.answer_in("instrument or temporal", cats)["confidence"] == 0.0
    assert dc.answer_in('{"category": "none"} {bad}', cats)["category"] is None and dc.answer_in(None, cats)["category"] is None
    now, waits, calls = [0.0], [], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    def client(texts):
        calls.append(texts)
        if len(calls) in (2, 3):
            raise OSError
        return [{}] * len(texts)

    paced = dc.paced(client, per_minute=2, clock=lambda: now[0], sleep=sleep)
    paced(["a"]), paced(["b"])
    assert len(calls) == 4 and len(waits) >= 3 and now[0] > 30
    with pytest.raises(OSError):
        dc.paced(lambda t: (_ for _ in ()).throw(OSError()), retries=1, clock=lambda: 0.0, sleep=lambda s: None)(["x"])
    ask = lambda prompt: '[{"category": "temporal", "confidence": 0.9}, {"category": "instrument"}]' if "1. x\n2. y" in prompt and "instrument, temporal" in prompt else ""
    assert [a["category"] for a in dc.text_client(ask, cats)(["x", "y"])] == ["temporal", "instrument"]


def test_discovery_in_two_passes(spark):
    t = _simple(spark, [(i, "part of the Drug Abuse  Screening Test here") for i in "ABC"])
    p = spark.createDataFrame([("as part of the Drug Abuse Screening Test",)], "pattern string")
    r = dc.discovery_run(t, p).collect()
    assert [(x.verbatim, x["pass"], x.n_ids, x.n_definition) for x in r] == [("Drug Abuse  Screening Test", "bare", 3, 3)]
    scope = spark.createDataFrame([("as part of the Drug Abuse Screening Test", "A"), ("as part of the Drug Abuse Screening Test", "B")], "pattern string, tinyId string")
    assert [x.n_ids for x in dc.discovery_run(t, p, scopes=scope).collect()] == [2]


def test_renaming_and_joined_objects(spark):
    df = spark.createDataFrame([("A", "n", [("1", "x"), (None, "y"), ("2", None)])], "tinyId string, NAME string, v array<struct<a string, b string>>")
    assert fields.renamed(df).columns == ["tinyId", "name", "v"]
    with pytest.raises(ValueError):
        fields.renamed(df, {"tinyId": "x", "NAME": "X"})
    r = df.select(fields.joined_objects(F.col("v"), ["a", "b"]).alias("o")).first().o
    assert (r.a, r.b) == ("1;; 2", "x;; y")


def test_ranks_beyond_sixteen_bits_raise(spark):
    t = _simple(spark, [("A", "one")])
    with pytest.raises(ValueError):
        en.encode(t, spark.createDataFrame([("one", 65_536)], "token string, rank int"))


def test_dense_order_over_partitions(spark):
    df = spark.createDataFrame([(i, (i * 7) % 50) for i in range(200)], "id int, v int")
    got = {r.id: r["rank"] for r in cu.dense_order(df, ["v", "id"]).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(range(200), key=lambda i: ((i * 7) % 50, i)) and set(got.values()) == set(range(1, 201))


def test_contained_patterns_meet_through_automata(spark):
    p = spark.createDataFrame([("the",), ("The Pain",), ("pain",), ("a pain scale",), ("scale",), ("ain",), ("",), (None,)], "pattern string")
    got = {(r.short, r.long) for r in mt.inside(p, p).collect()}
    texts = ["the", "The Pain", "pain", "a pain scale", "scale", "ain"]
    assert got == {(a, b) for a in texts for b in texts if len(a) < len(b) and a.lower() in b.lower()}
