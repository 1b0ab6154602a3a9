"""Documents and their segments, whatever their files' size makes them seem, are not broadcast to questions."""

from foliomill.operators import answers
from foliomill.plans.all import QUERIES


def below(plan, node, mark):
    """Whether a line of the plan with mark hangs below one with node."""
    depth = None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if depth is not None and mark in line:
            return True
        if node in line and depth is None:
            depth = at
    return False


def test_no_exploded_documents(spark, sf):
    for name, mark in (("reference_answer", "p_partkey"), ("question_targets", "Generate explode")):
        found = QUERIES[name](spark, sf)
        assert not below(found._jdf.queryExecution().executedPlan().toString(), "BroadcastExchange", mark), name


def test_many_questions_are_merged(spark, sf, monkeypatch):
    few = sorted(map(tuple, QUERIES["question_targets"](spark, sf).collect()))
    monkeypatch.setattr(answers, "FEW_QUESTIONS", 3)
    found = QUERIES["question_targets"](spark, sf)
    assert sorted(map(tuple, found.collect())) == few
    assert not below(found._jdf.queryExecution().executedPlan().toString(), "BroadcastExchange", "Generate explode")
