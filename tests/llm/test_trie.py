import hashlib
import random
import zlib

import pytest

from foliomill.llm import trie


@pytest.fixture(params=[False, True], ids=["one block", "many blocks"])
def blocks(request, spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in names}
    if request.param:
        for k, v in names.items():
            spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(rows):
    """The contract, node by node; rows of (conv_id, turn, role, text), turns of a conversation distinct."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    return plain_nodes(built, nodes)


def plain_nodes(built, nodes):
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaf = lambda p: not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.add((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), sum(map(leaf, below)),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string").repartition(5)


def test_equals_a_plain_tree(spark, blocks):
    rng = random.Random(3)
    rows = [(c, t, ("user", "assistant", None)[t % 3], rng.choice(["a", "bb", "", None, "é😀"])) for c in [*range(0, 260), 500, 777, 901] for t in range(rng.choice([0, 1, 2, 3, 4, 9]))]
    rows += [(c, t, "user", "same") for c in range(1000, 1060) for t in range(7)]  # a conversation that many have
    rows += [(2000, t, "user", "long") for t in range(300)] + [(2001 + k, t, "user", "long") for k in range(9) for t in range(280)]
    rows += [(3000, None, "user", "first"), (3000, 1, "user", "second")]
    found = [tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain(rows)


def test_turnless_conversations_are_the_roots(spark):
    c = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 6 == 2)
    found = trie.prefix_trie(frame(spark, [(c, 0, "user", "x"), (c, 1, "user", "y")])).collect()
    assert [tuple(r) for r in found] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_repeated_rows_ties_nulls_and_empty_tables(spark):
    rows = [(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "b"), (None, 0, "user", "c")]
    found = sorted((tuple(r) for r in trie.prefix_trie(frame(spark, rows)).collect()), key=lambda r: r[1])
    assert [r[:2] for r in found] == [(0, 0), (0, 1), (0, 2), (0, 3)] and [r[3] for r in found] == [1] * 4
    assert trie.prefix_trie(frame(spark, [])).count() == 0


def test_fold_in_blocks_of_any_size():
    """Pieces and minima of small blocks agree with a count over all keys."""
    rng = random.Random(5)
    some = sorted({bytes(rng.choice(b"ab") for _ in range(1)) * trie.UNIT * rng.randint(0, 3) + bytes([rng.choice(b"abc")]) * trie.UNIT * rng.randint(0, 4) for _ in range(60)})
    rows, prior = [], None
    for b in range(0, len(some), 4):
        if prior is not None:
            rows.append((b, -1, prior, None, None, None))
        rows += [(b, b + i, k, 1, b + i, "e") for i, k in enumerate(some[b : b + 4])]
        prior = some[min(b + 3, len(some) - 1)]
    out = list(trie.fold(rows))
    prefixes = {k[: d * trie.UNIT] for k in some for d in range(len(k) // trie.UNIT + 1)}
    assert sum(r[0] in (trie.NODE, trie.OPENING) for r in out) == len(prefixes)
    assert sum(r[6] for r in out if r[0] != trie.BLOCK and r[3] == 0) == len(some)


def test_shared_units():
    a = b"".join(bytes([i % 7]) * trie.UNIT for i in range(500))
    for n in (0, 1, 63, 64, 65, 320, 499, 500):
        assert trie.shared(a, a[: n * trie.UNIT] + b"x" * trie.UNIT) == n == trie.shared(a[: n * trie.UNIT], a)
