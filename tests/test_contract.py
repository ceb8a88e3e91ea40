"""The driver's contract: queries, SQL and a separable subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from textlens.plans.catalog import catalogue  # noqa: E402

QUERIES, ORACLES = catalogue()


def test_sql_has_queries():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 90


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def _cell(x):
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return tuple(_cell(y) for y in x)
    if x is None or x != x or type(x).__name__ in ("NaTType", "NAType"):
        return None
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return bool(x)
    if isinstance(x, (int, float)) or "int" in type(x).__name__ or "float" in type(x).__name__ or type(x).__name__ == "Decimal":
        return round(float(x), 4)
    return str(x)


def rows(pdf):
    return sorted(repr(tuple(_cell(v) for v in r)) for r in pdf[sorted(pdf.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    c = duckdb.connect()
    for f in Path(small).iterdir():
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want, got = c.sql(ORACLES[name]).df(), QUERIES[name](spark, small).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    QUERIES[name](spark, small).count()


def test_core_imports_without_the_llm_subpackage():
    code = "import sys; sys.modules['textlens.llm'] = None; import __spark_entry__ as e; assert 'p2_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_scratch_tables_in_a_plain_session(tmp_path):
    code = (
        "import os, sys; sys.path.insert(0, '.')\n"
        "from textlens import session as s\n"
        "spark = s.local_session(1, '1g', 1)\n"
        "assert spark.sparkContext.getConf().get('spark.checkpoint.dir') is None\n"
        "a, b = s.written(spark.range(3), 'a'), s.written(spark.range(4).selectExpr('id', 'id % 2 as p'), 'b', ['p'])\n"
        "assert a.count() == 3 and b.columns == ['id', 'p'] and s.written(spark.range(0).selectExpr('id', 'id as p'), 'c', ['p']).count() == 0\n"
        "assert s.cut(spark.range(5)).count() == 5\n"
        "where = s.shared_dir(spark)[7:]\n"
        "s.discard(a); assert len([x for x in os.listdir(where) if x[0] in 'abc' and x[1] == '-']) == 2\n"
        "s.sweep(); assert not [x for x in os.listdir(where) if x[0] in 'abc' and x[1] == '-']\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CONF_DIR"} | {"SPARK_CONF_DIR": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=180, env=env)
