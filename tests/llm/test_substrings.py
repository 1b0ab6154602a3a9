import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from foliomill.llm import substrings

from .helpers import TEXTS, documents


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(texts, window):
    """(n_words, n_removed, kept) of each text, from a count of all windows."""
    all_words = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = {k for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    some = lambda n, k: " ".join(rng.choice(["é", "日本", "x", "#"]) + str(rng.randrange(k)) for _ in range(n))
    passages = [some(n, 10**6) for n in (34, 35, 36, 50, 80, 300)]
    texts = list(TEXTS)
    for k in range(40):
        texts.append(" ".join([some(rng.randrange(60), 10**6), rng.choice(passages), "\n\t" + some(rng.randrange(40), 10**6), rng.choice(passages), some(3, 9)]))
    texts += [some(200, 2), some(200, 2), "a " * 100, "a b " * 90, "a " * 34, "a " * 35, "a " * 36, "z" * 70_000 + " " + some(50, 10**6), passages[5], passages[5], passages[2]]
    near = some(400, 10**6)
    texts += [near.replace(near.split()[k], "other") for k in range(0, 300, 30)] + [near + " ", near]
    return texts


@pytest.mark.parametrize(("window", "heavy"), [(35, None), (35, 1), (12, None), (9, 2)])
def test_equals_a_count_of_all_windows(spark, monkeypatch, window, heavy):
    if heavy:
        monkeypatch.setattr(substrings, "HEAVY", heavy)
    texts = corpus()
    docs = documents(spark, texts).withColumnRenamed("n_chars", "n_words")
    rows = {r["doc_id"]: r for r in substrings.remove(docs, window=window).collect()}
    assert len(rows) == len(texts)
    for k, (n, gone, kept) in enumerate(plain(texts, window)):
        assert (rows[k][-3], rows[k][-2], rows[k][-1]) == (n, gone, kept), k
    assert rows[3]["n_words_" if "n_words_" in rows[3] else "n_words"] is not None


def test_no_group_is_cut_where_batches_end(monkeypatch):
    monkeypatch.setattr(substrings, "AT_ONCE", 50)
    rng = random.Random(2)
    some = [" ".join(str(rng.randrange(10**6)) for _ in range(20)) for _ in range(30)]
    rows = sorted((rng.randrange(5), bytes([i % 30]), i, some[i % 30]) for i in range(600))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["gram", "digest", "start", "words"])
    found = [r for b in substrings._grown(10)(batch.slice(k, 7) for k in range(0, 600, 7)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    count = Counter((g, w) for g, _, _, w in rows)
    assert sorted(found) == sorted((d, i, i + 20) for g, d, i, w in rows if count[g, w] > 1)


def test_runs_share_a_gram_wherever_a_window_starts():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**63, 120).astype(np.uint64)
    sizes = np.array([200, 34, 150])
    hashes = rng.integers(0, 2**63, sizes.sum()).astype(np.uint64)
    hashes[30:150], hashes[250:370] = one, one
    text, gram, start, size, twice = substrings.runs(hashes, sizes)
    of = lambda t: {int(s + k): int(g) for x, g, s, n in zip(text, gram, start, size, strict=True) if x == t for k in range(n)}
    a, b = of(0), of(2)
    assert len(a) == 166 and not of(1) and len(b) == 116
    assert [a[30 + k] for k in range(86)] == [b[16 + k] for k in range(86)]
    assert not twice.any()
    assert substrings.runs(np.ones(100, np.uint64), np.array([100]))[4].all()


def test_word_hashes_of_long_texts():
    text = ("mot " * 40_000 + "x" * 200_000 + " mot\tfin").encode()
    raw = np.frombuffer(text, np.uint8)
    begin, end = substrings.word_bounds(raw, np.array([0, len(raw)]))
    assert [text[b:e] for b, e in zip(begin, end, strict=True)] == text.split()
    found = substrings.word_hashes(raw, begin, end)
    assert len(set(found[:40_000].tolist())) == 1 and found[0] == found[40_001] and len(set(found.tolist())) == 3


def test_empty_table_and_no_texts(spark):
    assert substrings.remove(documents(spark, [], [])).count() == 0
    rows = substrings.remove(documents(spark, [None, "", "a b"])).orderBy("doc_id").select("n_words", "n_removed", "kept").collect()
    assert [tuple(r) for r in rows] == [(0, 0, ""), (0, 0, ""), (2, 0, "a b")]
