"""Every registered query against its SQL, and plan rules for all lazy ones."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    found = contract.queries()[name](spark, SMALL)
    assert difference(found, duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1500


def test_every_survey_id_is_registered():
    ids = {name.split("_")[0] for name in contract.queries()}
    assert {f"m{i}" for i in range(1, 16)} <= ids
    assert {f"e{i}" for i in range(1, 17)} <= ids
    assert {f"j{i}" for i in range(1, 12)} <= ids
    assert {f"a{i}" for i in range(1, 14)} <= ids
    assert {f"w{i}" for i in range(1, 8)} <= ids
    assert {f"q{i}" for i in range(1, 12)} <= ids
    assert {f"r{i}" for i in range(1, 11)} <= ids
    assert {f"c{i}" for i in range(1, 9)} <= ids
    assert {f"i{i}" for i in range(1, 9)} <= ids
    assert {"t1", "t2", "t3", "g1", "g2", "l1", "l2", "l3"} <= ids


@pytest.mark.parametrize("name", [n for n in contract.queries() if re.match(r"[mejawrcgqf]\d", n) and not re.match(r"m(7|8|9|15)_", n)])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    """Also with broadcasts off, as for tables too large for them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert word not in plan, word


def test_a_missing_library_of_the_text_part_leaves_the_rest(tmp_path):
    """Also with the text part's folder in place, as far as it is there."""
    (tmp_path / "zstandard.py").write_text("raise ModuleNotFoundError('none here', name='zstandard')")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, 'op3_language_id' in q)"
    root = str(Path(contract.__file__).parent)
    env = {**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, cwd=root, timeout=120)
    number, *present = done.stdout.split()
    assert int(number) > 130 and present == ["False", "False"], done.stderr
