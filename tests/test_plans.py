"""Shape of the physical plans, and what the package may not contain."""

import pathlib
import re

import pytest

from cardwatch.plans import QUERIES

ROOT = pathlib.Path(__file__).parent.parent
# Eager jobs whose result is a plain read of the table they wrote.
EAGER = {"train_model", "tune_model"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_sort_in_one_task(spark, key):
    plan = QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for above, below in zip(lines, lines[1:]):
        assert not (re.search(r"\bSort \[", above) and "Exchange SinglePartition" in below), above
    assert "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["prefix_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(p_type,PROMO)" in plan and "p_retailprice" not in plan
    plan = QUERIES["scan_project"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in plan
    plan = QUERIES["write_partitioned"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*event_type", plan)


#: Places that bring rows to the driver, how often, and what bounds them.
BOUNDED = {
    ("operators/boosting.py", "toLocalIterator"): (2, "at most 64 values per input; one row per fold and label"),
    ("operators/boosting.py", "toArrow"): (1, "sums and splits of open tree nodes: fits x leaves x bins"),
    ("streaming/jobs.py", "toLocalIterator"): (1, "one folder name per emptied window"),
}
WORDS = ("localCheckpoint", "toPandas", ".collect()", "crossJoin", "toLocalIterator", "toArrow", ".rdd")


def test_package_keeps_rows_on_the_executors():
    package = ROOT / "cardwatch"
    found = {}
    for path in package.rglob("*.py"):
        name = path.relative_to(package).as_posix()
        if not name.startswith("llm/"):  # has a test of its own
            found |= {(name, w): n for w in WORDS if (n := path.read_text().count(w))}
    assert found == {place: n for place, (n, _) in BOUNDED.items()}
