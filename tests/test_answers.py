"""Answers by reference, excerpts and suspect passages against plain versions."""

import random
import re

from foliomill.operators import answers, passages, proofreading


def test_article_then_subject_then_presentation(spark):
    docs = spark.createDataFrame([(1, "reglement-general", "base", "Règlement Général", None, None), (2, "i12", "instruction", "Instruction 12", "2010", "12/2010"), (3, "r5", "rapport", "Rapport", "2005", "")], "doc long, slug string, type string, title string, year string, number string")
    asked = spark.createDataFrame([(1, "article 37 du règlement général"), (2, "instruction 12 agrément"), (3, "instruction 12"), (4, "rapport annuel 2005")], "query int, text string")
    rows = [(1, 0, "Article 36", "x", True, "capital"), (1, 1, "Article 37", "y", True, "autre"), (2, 0, "", "", False, "en-tête"), (2, 1, "Article premier", "Champ", True, "capital social"), (2, 2, "Article 2", "Objet", True, "sur l'agrément des sociétés"), (3, 0, "", "", False, "début")]
    segs = spark.createDataFrame(rows, "doc long, segment int, mark string, title string, article boolean, text string")
    refs = answers.parsed(asked)
    found = answers.targets(refs, docs)
    got = {(r["query"], r["doc"]): (r["segment"], r["how"]) for r in answers.reference_answers(refs, found, segs).collect()}
    assert got == {(1, 1): (1, "article"), (2, 2): (2, "subject"), (3, 2): (2, "presentation"), (4, 3): (0, "first segment")}
    assert {r["query"]: r["route"] for r in answers.routed(refs, found).collect()} == {1: "reference", 2: "reference", 3: "reference", 4: "reference"}


def test_excerpts_hold_the_hit_and_end_at_words(spark):
    r = random.Random(2)
    words = ["alpha", "beta", "gamma.", "delta", "epsilon", "mention", "zeta."]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (0, 5, 60, 200, 400, 900) for _ in range(12)] + ["x" * 700 + " mention " + "y" * 700, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in passages.excerpts(docs, ["mention"]).collect():
        text, got = texts[row["doc_id"]] or "", row["excerpt"]
        body = got.removeprefix("… ").removesuffix(" …")
        assert body in text and len(body) <= 480 + 120 + 220
        if len(text) <= 480 and ". " not in text[-32:]:
            assert got == text
        if "mention" in text and len(text) > 520:
            assert "mention" in body
        if "xxx" not in text and text:
            assert set(body.split()) <= set(words), body


def test_contexts_equal_a_plain_scan(spark):
    r = random.Random(5)
    parts = ["1a2", "x1234", "Il1", "0a", " , ", "»", "12 345 678 901", "¤", "artlcle", "rnillion", "mot", "é", "\n", " "]
    pages = ["".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randint(0, 40))) for _ in range(40)] + [""]
    got = {}
    for x in proofreading.contexts(spark.createDataFrame([(1, i, t) for i, t in enumerate(pages)], "doc int, page int, text string")).orderBy("page", "place").collect():
        got.setdefault(x["page"], []).append((x["label"], x["context"]))
    for i, t in enumerate(pages):
        want = []
        for label, pattern in proofreading.SUSPECTS:
            flags = (re.M if "m" in pattern.split(")")[0] else 0) | (re.I if "(?i" in pattern else 0)
            for m in re.finditer(re.sub(r"^\(\?[a-zU]+\)", "", pattern), t, flags):
                want.append((label, t[max(0, m.start() - 45) : m.end() + 45].replace("\n", " ").strip()))
        assert got.get(i, []) == want[:14]
