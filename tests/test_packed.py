"""Packed cells (problem 4)."""

import pytest
from hypothesis import given, settings, strategies as st

from textlens.operators import packed as pk


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ('a|"b; c", d', ["a", "b; c", "d"]), ("'x, y','z'", ["x, y", "z"]), ("patient's pain|the patient's pain", ["patient's pain", "the patient's pain"]),
        ('"say ""raw"""|b', ['say "raw"', "b"]), ('"a \\"q\\" b";c', ['a "q" b', "c"]), ("a||b;; c|", ["a", "b", "c"]), ("one\ntwo\tthree four", ["one", "two", "three four"]),
        ('"open|b', ['"open', "b"]), ("", []), ("  ", []), (None, []), ("a|a", ["a", "a"]), ("[a], [b c]", ["a", "b c"]), ("a (total)|(b)", ["a (total)", "(b)"]), ("['a', 'b c']", ["a", "b c"]),
    ],
)
def test_variants(cell, want):
    assert pk.segment(cell, None) == want


@pytest.mark.parametrize(("cell", "want"), [("x1 y2|z3,,w4", ["x1", "y2", "z3", "w4"]), ('"a1|b2"', ["a1", "b2"]), ("['a1', \"b2\"]", ["a1", "b2"]), ("'a1' b2\n'c3'", ["a1", "b2", "c3"])])
def test_words(cell, want):
    assert pk.segment(cell, None, words=True) == want


def test_dictionary_protects_separators():
    known = pk.automaton(["alcohol use, count", "a|b"])
    assert pk.segment("Alcohol use, count|x, alcohol use, grade", known) == ["Alcohol use, count", "x", "alcohol use", "grade"]
    assert pk.segment("p;a|b", known) == ["p", "a|b"]
    assert pk.segment("xa|b", known) == ["xa", "b"]  # not a whole value


def test_only_the_dictionary_keeps_an_unquoted_value_whole(spark):
    df = spark.createDataFrame([(1, "Heat  exposure, change from baseline|b"), (2, "x; heat exposure, other"), (3, "a, b; c, d, e"), (4, '"a, b", c')], "id bigint, cell string")
    known = spark.createDataFrame([("heat exposure, change from baseline",), ("b; c, d",), ("plain",), ("a, b, z",)], "value string")
    items = lambda rows: [[r.item for r in sorted(rows, key=lambda r: r.pos) if r.row_id == i] for i in range(1, 5)]
    plain = [["Heat  exposure", "change from baseline", "b"], ["x", "heat exposure", "other"], ["a", "b", "c", "d", "e"], ["a, b", "c"]]
    assert items(pk.split_packed(df, "id", "cell", None).collect()) == plain
    assert items(pk.split_packed(df, "id", "cell", known).collect()) == [["Heat  exposure, change from baseline", "b"], plain[1], ["a", "b; c, d", "e"], plain[3]]


def test_single_words_need_no_dictionary(spark):
    df = spark.createDataFrame([(1, "x1,y2 z3")], "id bigint, cell string")
    out = pk.split_packed(df, "id", "cell", spark.createDataFrame([("x1,y2",)], "value string"), words=True)
    assert [r.item for r in sorted(out.collect(), key=lambda r: r.pos)] == ["x1", "y2", "z3"]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_operator_on_awkward_tables(spark):
    long = "|".join(f"v{i}" for i in range(5000))
    df = spark.createDataFrame([(1, "a|b", "z"), (1, "a|b", "y"), (2, None, "z"), (3, "", "z"), (4, long, "z"), (None, "n", "z")], "id bigint, cell string, pos string")
    known = spark.createDataFrame([("a|b",), (None,), ("",)], "value string")
    rows = pk.split_packed(df, "id", "cell", known).collect()
    by = {}
    for r in rows:
        by.setdefault(r.row_id, []).append((r.pos, r.item))
    assert by[1] == [(1, "a|b")] and 2 not in by and 3 not in by and by[None] == [(1, "n")]
    assert sorted(by[4])[-1] == (5000, "v4999") and len(by[4]) == 5000
    assert pk.split_packed(df.limit(0), "id", "cell", known).count() == 0
    assert pk.split_packed(df.where("id = 1"), "id", "cell", known.limit(0)).count() == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab c'", min_size=1, max_size=6).filter(lambda s: s.strip() == s and s[0] not in "'\"" and "'" not in s[-1:]), max_size=6), st.sampled_from("|,;\n\t"))
def test_quoted_round_trip(values, sep):
    cell = sep.join('"' + v.replace('"', '""') + '"' for v in values)
    assert pk.segment(cell, None) == values
