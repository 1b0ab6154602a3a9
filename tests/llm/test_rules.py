import random
import re
from collections import Counter

from foliomill.llm import rules

from .helpers import TEXTS, documents


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {p for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def test_base_figures_equal_a_plain_version(spark):
    r = random.Random(8)
    voc = ["a", "b", "cé", "d#", "|", "日"]
    texts = TEXTS + ["".join(r.choice([w + " " for w in voc] + ["\n", "\x0b", "\x1c"]) for _ in range(r.randint(1, 120))) for _ in range(60)]
    got = {x["doc_id"]: x for x in rules.annotate(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == plain(t), t
        assert not (x["base_failed"] and x["kept"])


GOOD = "It was a long story, told in plain sentences about nothing in particular by people who knew each other well."


def test_lines_go_first_and_documents_that_lose_too_much(spark):
    texts = [GOOD, f"Home | About | Contact | Help | Login\n{GOOD}\nAll rights reserved.", f"{GOOD}\n" + "A | B | C | D | E | F | G | H | I | J | K | L | M | N\n" * 4, GOOD.upper(), "word " * 40, " ".join(f"w{i}&&&" for i in range(40))]
    got = {x["doc_id"]: x for x in rules.annotate(documents(spark, texts)).collect()}
    assert [got[i]["kept"] for i in range(6)] == [True, True, False, False, False, False]
    assert got[1]["cleaned"] == GOOD


def test_punctuation_menus_and_notices(spark):
    long = " ".join(f"word{i}" for i in range(40)) + ", and then they said: Accept all cookies. " + " ".join(f"more{i}" for i in range(40)) + "."
    menu = "Home News Sport Weather Travel Culture Music Books Shop Jobs Contact Login\n" * 2
    texts = [
        long, menu + " ".join(f"item{i}" for i in range(20)), f"A heading\n{GOOD}", GOOD.removesuffix(".") + " and so it went. It was never told again, or",
        "\n".join(f"Tous droits réservés {i}, conditions d'utilisation et politique de confidentialité du site." for i in range(5)), "\n".join(f"Alle Rechte vorbehalten, Teil {i} der Nutzungsbedingungen." for i in range(5)),
        " ".join(f"日本{i}。" for i in range(30)), f"{GOOD[:-1]}.”\n(Nobody else had heard of it, or so they said!)",
    ]
    got = {x["doc_id"]: x for x in rules.annotate(documents(spark, texts)).collect()}
    assert [got[i]["kept"] for i in range(8)] == [True, False, True, True, False, False, True, True]
    assert got[2]["cleaned"] == GOOD and got[0]["cleaned"] == long


def test_odd_rows(spark):
    got = {x["doc_id"]: x for x in rules.annotate(documents(spark)).collect()}
    assert not got[0]["kept"] and got[0]["cleaned"] == "" and got[0]["lost"] == 0.0
    assert rules.annotate(documents(spark, [], [])).count() == 0
    assert rules.annotate(documents(spark, [GOOD] * 2, [1, 1])).count() == 2
    docs = documents(spark)
    assert set(docs.columns) <= set(rules.annotate(docs).columns)
