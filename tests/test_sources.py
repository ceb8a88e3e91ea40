"""Readers, writers, workflow, streams."""

import json

import pytest
from pyspark.sql import functions as F

from textlens.plans.workflow import Step, Workflow, resolve
from textlens.operators import curation as cu
from textlens.sources import files
from textlens.streaming import terms


def test_records_and_broken_lines(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text('{"tinyId": "A", "designations": [{"designation": "x"}]}\n{"tinyId": "B", \n')
    good, bad = files.read_records(spark, str(p), lines=True)
    good, bad = good.cache(), bad.cache()
    assert [r.tinyId for r in good.collect()] == ["A"] and bad.count() == 1
    q = tmp_path / "a.json"
    q.write_text(json.dumps([{"tinyId": "A"}, {"tinyId": "B"}], indent=1))
    assert files.read_records(spark, str(q))[0].count() == 2


def test_patterns_ids_and_scopes(spark, tmp_path):
    p = tmp_path / "p.tsv"
    p.write_text('Pattern\ttinyIds\treplace_with\nfoo\tA B|C\tx\n"say ""hi"""\t\t\nfoo\tZ\ty\n')
    got = {r.pattern: (r.ids, r.replace_with) for r in files.read_patterns(spark, str(p)).collect()}
    assert got == {"foo": (["A", "B", "C"], "x"), 'say "hi"': ([], "")}
    long = {(r.pattern, r.tinyId) for r in files.pattern_ids(files.read_patterns(spark, str(p))).collect()}
    assert ("foo", "A") in long and ('say "hi"', None) in long
    i = tmp_path / "i.csv"
    i.write_text("id,x\nA;B,1\nB,2\n")
    assert [r.id for r in files.read_ids(spark, f"{i}:id").orderBy("ord").collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        files.read_patterns(spark, f"{p},none")


def test_small_files(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("x: [1]\ny: 1\n")
    (tmp_path / "b.yaml").write_text("x: [2]\ny: 2\n")
    assert files.read_config(str(tmp_path / "a.yaml"), str(tmp_path / "b.yaml"), str(tmp_path / "none.yaml")) == {"x": [1, 2], "y": 2}
    (tmp_path / "s.csv").write_text("tag,path\nName,designations.0.designation\n")
    assert files.read_path_schema(str(tmp_path / "s.csv")) == {"Name": "designations.0.designation"}
    (tmp_path / "r.txt").write_text("# c\na+\tlabel\n\nb\n")
    assert [(r.pattern, r.label) for r in files.read_regexes(spark, str(tmp_path / "r.txt")).collect()] == [("a+", "label"), ("b", "")]
    assert files.bracket_scopes({"[A]": ["1"], "A": ["2"], "[B]": None}) == {"[A]": ["1"], "A": ["1", "2"], "[B]": None, "B": None}
    (tmp_path / "m.tsv").write_text("path\tphrase\treplace\ttinyIds\nd.*.x\tfoo\t\tA|B\n")
    assert files.read_phrase_map(spark, str(tmp_path / "m.tsv")).first().ids == ["A", "B"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", ["a", "b"])], "b string, a array<string>")
    files.write_flat(df, str(tmp_path / "o"))
    back = spark.read.csv(str(tmp_path / "o"), sep="\t", header=True, escape='"')
    assert back.columns == ["a", "b"] and json.loads(back.first().a) == ["a", "b"]
    assert "| 1 |" in files.markdown(df.select("b"), "t")


def test_dictionary_and_ledger(spark, tmp_path):
    d = tmp_path / "d.tsv"
    d.write_text("Abbreviation\texpansion\tcategory\tconfidence\tdecision\nAB\tx\tinstrument\t0.9\t\nCD\ty\tother\t0.9\tskip\n")
    df = files.read_dictionary(spark, str(d))
    files.write_dictionary(df, str(tmp_path / "out"))
    back = {r.abbreviation: r.decision for r in spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).collect()}
    assert back == {"AB": "tentative_strip", "CD": "skip"}
    led = tmp_path / "l.tsv"
    led.write_text("pattern\tdecision\tdecided_at\nfoo\tkeep\t2024-01-01\nfoo\tremove\t2024-02-01\nbar\tSTRIP\t\n")
    assert {r.pattern: r.decision for r in files.read_ledger(spark, str(led)).collect()} == {"foo": "skip", "bar": "strip"}


def test_gate_and_sheets(spark):
    c = spark.createDataFrame([("a", "auto_strip", "strip", None), ("b", "review_new", None, None), ("c", "review_changed_skip", "skip", None)], "pattern string, status string, prior string, modification string")
    auto, review = cu.gate(c)
    assert [r.pattern for r in auto.collect()] == ["a"] and {r.pattern: r.notes for r in review.collect()} == {"b": "", "c": "previously skip; new records"}
    assert cu.sheets(c.select("pattern"), ["x", "y"]).count() == 6
    filled = spark.createDataFrame([("x", "a", "keep"), ("y", "a", "strip"), ("x", "b", "skip"), ("y", "b", "strip"), ("y", "c", " ")], "curator string, pattern string, decision string")
    agreed, open_ = cu.merge_sheets(filled)
    assert {r.item: r.consensus for r in agreed.collect()} == {"a": "strip", "b": "strip"} and [r.item for r in open_.collect()] == ["b"]


def test_variables():
    assert resolve("${A:-x}/${B}", {"B": "b"}) == "x/b"
    assert resolve(["${A}"], {"A": "${B}", "B": "c"}) == ["c"]
    assert resolve("${NOPE_X}", {}) == "${NOPE_X}"


def test_workflow(spark, tmp_path):
    one = Step("one", lambda s, t, v: t["x"].where("id > 1"))
    two = Step("two", lambda s, t, v: t["one"].withColumn("y", F.lit(v["n"])), condition="${go}")
    w = Workflow("w", [one, two], {"go": "yes", "n": 3})
    x = {"x": spark.range(4)}
    out = w.run(spark, x, state=str(tmp_path / "s.json"))
    assert out["tables"]["two"].count() == 2 and json.loads((tmp_path / "s.json").read_text())["status"]["two"] == "completed"
    assert w.run(spark, x, {"go": "no"})["status"]["two"] == "condition false"
    assert w.run(spark, x, dry_run=True)["status"] == {"one": "would run", "two": "would run"}
    assert w.run(spark, x, only=["one"])["status"]["two"] == "not selected"
    with pytest.raises(ValueError):
        w.run(spark, x, start="none")


def test_streams(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    rows = [("a", "2024-01-01 00:00:00", "strip"), ("a", "2024-01-02 00:00:00", "skip"), ("b", "2024-01-01 00:00:00", "strip")]
    df = spark.createDataFrame(rows, "k string, at string, d string").select("k", F.to_timestamp("at").alias("at"), "d")
    df.limit(1).write.parquet(str(src / "1"))
    schema = df.schema

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(src))
        terms.ledger_stream(stream, str(out), str(tmp_path / "cp"), ["k"], "at").trigger(availableNow=True).start().awaitTermination(60)

    run()
    df.where("k = 'b' or d = 'skip'").write.parquet(str(src / "2"))
    run()
    assert {r.k: r.d for r in terms.current(spark, str(out)).collect()} == {"a": "skip", "b": "strip"}
    counts = terms.windowed_counts(df, "at", ["k"]).collect()
    assert len(counts) == 3
