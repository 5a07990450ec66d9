"""What every physical plan must look like."""

import re

PYTHON_NODES = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups|PythonUDF")


def nodes(plan):
    yield plan
    for below in (plan.children(), plan.subqueries()):
        for i in range(below.size()):
            yield from nodes(below.apply(i))


def check_plan(name, df):
    """No Python in the row path, no pairing of whole tables, no window over a whole table, no unproven broadcast hint."""
    execution = df._jdf.queryExecution()
    plan = execution.sparkPlan()
    assert not PYTHON_NODES.search(plan.toString()), name
    for node in nodes(plan):
        kind = node.nodeName()
        assert "CartesianProduct" not in kind and "BroadcastNestedLoopJoin" not in kind, name
        if kind == "Window":
            assert not node.partitionSpec().isEmpty(), name
    assert "ResolvedHint (strategy=broadcast)" not in execution.analyzed().toString(), name
