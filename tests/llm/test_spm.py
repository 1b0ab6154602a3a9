import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from foliomill.llm import spm

from .helpers import TEXTS, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(lib, texts):
    got = spm.Coder(PATH).encode(texts)
    want = lib.encode(texts, add_bos=True, add_eos=True)
    for t, a, b in zip(texts, got, want, strict=True):
        assert np.frombuffer(a, "<u4").tolist() == b, t[:80]
    coder = spm.Coder(PATH)
    assert [coder.decode(np.array(x)) for x in want] == lib.decode(want)


def test_odd_texts_equal_the_library(lib):
    same(lib, ["", " ", "  ", "   a", "a  ", "▁x ▁▁ y", "<s> hi </s> <unk> <0x0A>", "\n\n\n x\t\ty", "a" * 500, "the" * 300, " " * 77 + "zz", "日本語 😀\x00", "l'été 12345", "▁", " ▁ ", "x" + " " * 40])


@pytest.mark.parametrize("alphabet", ["aeths ▁", "abcdethin   .,▁éß日😀\n\t=-_0123 ABC"])
def test_random_texts_equal_the_library(lib, alphabet):
    r = random.Random(len(alphabet))
    same(lib, ["".join(r.choice(alphabet) for _ in range(r.randint(1, 200))) for _ in range(1500)])


def test_random_ids_decode_as_the_library(lib):
    r = random.Random(2)
    coder = spm.Coder(PATH)
    for _ in range(300):
        ids = [r.randrange(32000) for _ in range(r.randint(0, 30))]
        assert coder.decode(np.array(ids, int)) == lib.decode(ids)


def test_cache_is_bounded(lib, monkeypatch):
    monkeypatch.setattr(spm, "CACHE", 5)
    coder = spm.Coder(PATH)
    for t in (["alpha beta gamma"], ["delta epsilon zeta eta theta"], ["alpha beta"]):
        assert np.frombuffer(coder.encode(t)[0], "<u4").tolist() == lib.encode(t[0], add_bos=True, add_eos=True)


def test_tables_round_trip(spark, lib):
    docs = documents(spark)
    out = spm.decode(spm.encode(docs, PATH), PATH)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    for r in out.collect():
        assert r["ids"] == lib.encode(r["text"] or "", add_bos=True, add_eos=True) and r["decoded"] == (r["text"] or "")
    both = spm.round_trip(docs, PATH)
    assert both.columns == [*(c for c in docs.columns if c != "text"), "ids", "decoded"]
    assert {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in both.collect()} == {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out.collect()}
    assert {r["doc_id"] for r in spm.digests(out).collect()} == set(range(len(TEXTS)))
    assert spm.encode(documents(spark, [], []), PATH).count() == 0
