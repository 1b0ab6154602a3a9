from itertools import permutations

from foliomill.llm import audit

from .helpers import TEXTS, documents, labels

MORE = ["word " * 250, "".join(f"w{i} " for i in range(250)), "".join(f"W{i} " for i in range(250)), "".join(f"w{i} " for i in range(250)) + "#", "".join(f"w{i} " for i in range(250))]


def plain(rows, label):
    """Rows of (id, text, lang) through every order, one document at a time."""
    said = {}
    for i, quality, toxic in label:
        old = said.get(i, (False, False))
        said[i] = (old[0] or quality == 1, old[1] or toxic == 1)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in t).split(" ") if x]
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t)}
        fails["E"] = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        docs.append((lang or "", fails, *(said.get(i, (False, False)) if i is not None else (False, False))))
    out = {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                hit = [d for d in left if d[1][x]]
                redundant = sum(d[1][x] for d in gone)
                left = [d for d in left if not d[1][x]]
                gone += hit
                alone = sum(d[0] == part and d[1][x] and sum(d[1].values()) == 1 for d in docs)
                out[part, order, step] = [len(left), len(hit), redundant, alone, sum(d[2] for d in hit), sum(d[3] for d in hit)]
    total = {}
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + v[1]
    return {(p, o, s, *v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_equals_a_plain_replay(spark):
    texts = TEXTS + MORE + MORE
    ids = [None if k == 2 else k // 2 if k < 6 else 100 - k for k in range(len(texts))]
    docs = documents(spark, texts, ids)
    label = [(i, k % 2, k % 3 == 0 or None) for k, i in enumerate(ids[1:])] + [(4, 1, None), (77, None, 1), (None, 1, 1)]
    label = [(i, q, None if t is None else int(t)) for i, q, t in label]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    found = [tuple(r) for r in audit.audit(docs, labels(spark, label)).collect()]
    assert len(found) == len(set(found)) == 600 * len({r[2] for r in rows})
    assert set(found) == plain(rows, label)


def test_empty_tables(spark):
    assert audit.audit(documents(spark, [], []), labels(spark, [])).count() == 0
    assert audit.audit(documents(spark, ["x"]), labels(spark, [])).count() == 600


def test_only_sums_are_shuffled_after_the_cross(spark):
    plan = audit.audit(documents(spark), labels(spark, [(1, 1, 0)]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "CartesianProduct" not in plan
    assert plan.count("partial_sum") >= 6 and "Python" not in plan
