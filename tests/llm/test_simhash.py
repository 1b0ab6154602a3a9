import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from foliomill.llm import simhash

from .helpers import TEXTS, documents


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values):
    """value -> smallest value reachable over links of 4 bits or fewer."""
    own = sorted(set(values))
    root = {v: v for v in own}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(own):
        for b in own[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in own}


def test_fingerprints_equal_a_plain_version(spark):
    texts = [t for t in TEXTS if t is None or len(t) < 10_000] + ["ÀB c\x0bd\x1ce f", "A B C", "a b c"]
    got = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(documents(spark, texts)).collect()}
    assert all(got[i] & (2**64 - 1) == plain(t) for i, t in enumerate(texts))


def near(seed, n, clusters):
    r = random.Random(seed)
    out = []
    for _ in range(clusters):
        v = r.getrandbits(64)
        for _ in range(n):
            out.append(v)
            w = v
            for _ in range(r.randint(1, 5)):
                w ^= 1 << r.randrange(64)
            v = w if r.random() < 0.5 else v
            out.append(w)
    return [x - (1 << 64) if x >> 63 else x for x in out]


def test_components_equal_brute_force(spark, monkeypatch):
    values = near(1, 12, 25) + [0, 1, -1, -2, 15, 16] + [random.Random(3).getrandbits(63) for _ in range(200)]
    for chunk, crowd, share in ((1 << 21, 1 << 17, 256), (3000, 3, 256), (1 << 21, 1, 4)):  # the others split routes by their next bits, and broadcast hubs
        for name, value in (("CHUNK", chunk), ("CROWD", crowd), ("SHARE", share)):
            monkeypatch.setattr(simhash, name, value)
        distinct = spark.createDataFrame([(v,) for v in sorted(set(values))], "fp long").repartition(3)
        found = {r["node"]: r["root"] for r in simhash.components(simhash.links(distinct)).collect()}
        want = groups(values)
        assert all(found.get(v, v) == want[v] for v in want)


def test_chunks_bound_memory_and_lose_nothing(monkeypatch):
    values = np.array(near(5, 40, 4), np.int64)
    fp = np.unique(values).view(np.uint64)
    monkeypatch.setattr(simhash, "CHUNK", 4000)
    pairs = [p for p in simhash.stars(fp, np.full(len(fp), 2), 64)]
    found = groups([])
    root = {int(v): int(v) for v in fp.view(np.int64)}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for hi, lo in pairs:
        for a, b in zip(hi.tolist(), lo.tolist(), strict=True):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = groups(fp.view(np.int64).tolist())
    assert found == {} and all(find(v) == want[v] for v in want)


def test_long_chain_settles(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)], "hi long, lo long")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def test_every_row_has_a_component_and_one_stays(spark):
    texts = TEXTS + [" ".join(f"word{i}" for i in range(400)), " ".join(f"word{i}" for i in range(399)) + " last", "zzz zz z zzzz zzz"]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    want = groups([plain(t) for t in texts])
    by_root = {}
    for i, t in enumerate(texts):
        by_root.setdefault(want[plain(t)], []).append(i)
    assert got == {i: min(own) for own in by_root.values() for i in own}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {min(x) for x in by_root.values()}


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + ["q w e r t y u i o p"] * 2, [None, 7, 7, None, None])
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r["component_id"] is None) for r in rows) == [False] * 3 + [True] * 2
    assert simhash.keep_one(docs).where(F.col("doc_id") == 7).count() == 1 and simhash.keep_one(docs).count() == 2
    assert simhash.near_duplicates(documents(spark, [], [])).count() == 0


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    texts, ids = [a, a, b, c, c, d, e, e, None, ""], [None, None, None, 7, 8, 7, 8, None, None, None]
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(documents(spark, texts, ids)).collect()), key=repr)
    assert [t for _, t in kept if t] and sorted(t or "" for _, t in kept) == sorted([a, b, c, d, e, ""])
    assert {(i, t) for i, t in kept if t} == {(None, a), (None, b), (7, c), (7, d), (8, e)}
