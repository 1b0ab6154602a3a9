import zlib
from collections import Counter

from foliomill.llm import sharding

from .helpers import TEXTS, documents


def test_deal_keeps_loads_even_and_slots_gapless():
    home = sharding.owners(5, 16)
    counts = [(p * 7919) % 11 if p % 3 else 0 for p in range(len(home))]
    counts[100] = 20_000  # a hot place
    pieces = sharding.deal(counts, home, 5)
    taken = {s: [] for s in range(5)}
    for n, own in zip(counts, pieces, strict=True):
        assert [x for b, e, _, _ in own for x in (b, e)] == ([] if not n else [0, *[x for b, e, _, _ in own for x in (b, e)][1:-1], n])
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
        for b, e, s, first in own:
            taken[s] += range(first, first + e - b)
    sizes = [len(v) for v in taken.values()]
    assert sum(sizes) == sum(counts) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in taken.values())


def test_ring_moves_little_when_a_shard_is_added():
    a, b = sharding.owners(24), sharding.owners(25)
    moved = [x for x, y in zip(a, b, strict=True) if x != y]
    assert 0 < len(moved) < 3 * len(a) / 25 and {y for x, y in zip(a, b, strict=True) if x != y} == {24}


def test_rows_law_sizes_and_checksums(spark):
    texts, ids = TEXTS * 30, [None if i % 50 == 9 else i // 2 for i in range(30 * len(TEXTS))]
    rows = sharding.assign(documents(spark, texts, ids), shards=7).collect()
    assert len(rows) == len(texts)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    at_home = sum(r["home"] == r["shard"] for r in rows)
    assert at_home > len(rows) / 2


def test_empty_table(spark):
    assert sharding.assign(documents(spark, [], [])).count() == 0


def test_hot_places_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HOT", 20)
    texts = TEXTS * 60
    ids = [None if i % 3 == 0 else i % 40 if i % 3 == 1 else i for i in range(len(texts))]  # a third without an id, a third of few ids
    rows = sharding.assign(documents(spark, texts, ids), shards=5).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sum(sizes.values()) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 8) for i, t in zip(ids, texts, strict=True))


def test_few_rows_move_under_loads():
    home, grown = sharding.owners(24), sharding.owners(25)
    counts = [(p * 7919) % 11 for p in range(len(home))]
    a, b = sharding.deal(counts, home, 24), sharding.deal(counts, grown, 25)
    of = lambda pieces: [s for begin, end, s, _ in pieces for _ in range(begin, end)]
    moved = sum(x != y for p, q in zip(a, b, strict=True) for x, y in zip(of(p), of(q), strict=True))
    assert 0 < moved < 0.1 * sum(counts)
