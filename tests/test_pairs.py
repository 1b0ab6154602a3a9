"""References and the texts they mean: each pair once, without a shuffle of pairs."""

import random

from foliomill.operators import integrity, references
from foliomill.plans.all import QUERIES


def exchanges(found):
    """Shuffles above the topmost join of the plan before it runs."""
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("Exchange" in x for x in lines[: next(i for i, x in enumerate(lines) if "Join" in x)])


def test_each_pair_once(spark):
    r = random.Random(4)
    refs = [(r.choice([*range(8), None]), r.choice(["a", "b", None]), str(r.randint(1, 4)), r.choice(["", "2003", "2004", None])) for _ in range(60)]
    docs = [(r.choice([*range(20), None]), r.choice(["a", "b", None]), r.choice(["1/2", "2-3/2003", "4", "", "3 3", None]), r.choice(["2003", "2004", None])) for _ in range(50)]
    found = references.resolved(spark.createDataFrame(refs, "source int, type string, number string, year string"), spark.createDataFrame(docs, "target int, type string, number string, year string"))
    rows = [tuple(x) for x in found.collect()]
    groups = lambda n: "".join(c if c.isdigit() else " " for c in n or "").split()
    want = {(s, d) for s, t, n, y in refs for d, kind, number, year in docs if t is not None and t == kind and n in groups(number) and (y == "" or (y is not None and y == year))}
    assert len(rows) == len(set(rows))
    assert set(rows) ^ want == set()
    assert not exchanges(found)


def test_no_shuffle_of_targets(spark, sf):
    assert not exchanges(QUERIES["reference_targets"](spark, sf))


def test_amending_once(spark, sf):
    refs = [(1, "3"), (1, "37"), (1, "3"), (2, "premier"), (2, "7"), (3, "12"), (None, "3")]
    docs = [(1, "article 3"), (4, "Article 37 et article 3"), (4, "l'Article premier, article 7"), (5, "ARTICLE 120 et 3"), (6, None), (2, "article premier")]
    found = integrity.amending(spark.createDataFrame(refs, "source int, article string"), spark.createDataFrame(docs, "target int, title string"))
    assert sorted(map(tuple, found.collect())) == [(1, 4), (2, 4), (3, 5)]
    assert not exchanges(found) and not exchanges(QUERIES["amending_texts"](spark, sf))
