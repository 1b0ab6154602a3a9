"""Block structure: pages with blocks written by hand, and what holds for any page."""

import random

from foliomill.operators import passages, structure


#: A page, and its blocks: kind, mark, text.
BY_HAND = [
    (
        "TITRE I : DES ACTEURS\nArticle premier : Objet\nLe présent article fixe les conditions d'agrément des sociétés de gestion et\nd'intermédiation établies sur le territoire de l'Union et de leurs succursales.\nPage 3/12",
        [("titre", "TITRE I", "DES ACTEURS"), ("article", "Article premier", "Objet"), ("paragraphe", "", "Le présent article fixe les conditions d'agrément des sociétés de gestion et d'intermédiation établies sur le territoire de l'Union et de leurs succursales.")],
    ),
    ("- une puce assez courte\n- autre puce de la liste", [("puce", "", "une puce assez courte"), ("puce", "", "autre puce de la liste")]),
    ("Premier alinéa de ce texte.\n\nSecond alinéa de ce texte.", [("paragraphe", "", "Premier alinéa de ce texte."), ("paragraphe", "", "Second alinéa de ce texte.")]),
    ("", []),
    ("\n\n", []),
]


LINES = [
    "TITRE I : DES ACTEURS", "Titre Il", "CHAPITRE premier", "Section 2 - De la forme", "SECTION III", "Article premier : Objet", "Article 2", "Art. 3 bis. Définitions", "- une puce assez courte", "• autre puce de la liste",
    "a) premier point", "12. douzième point", "", "   ", "Page 3/12", "- 4 -", "une ligne de texte pleine qui poursuit le paragraphe sans se terminer ici du", "fin de phrase.", "court", "une ligne qui se termine par un point mais qui est aussi longue que les autres ici.",
    "Le présent article fixe les conditions d'agrément des sociétés de gestion et", "suite de la puce qui est assez longue pour être absorbée par elle",
]


def blocks(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "doc int, text string").selectExpr("doc", "1 as page", "text")
    got = {i: [] for i in range(len(pages))}
    for x in structure.structured(df).orderBy("doc", "block_no").collect():
        got[x["doc"]].append((x["kind"], x["mark"], x["text"]))
    return got


def test_blocks_of_pages_written_by_hand(spark):
    got = blocks(spark, [page for page, _ in BY_HAND])
    assert [got[i] for i in range(len(BY_HAND))] == [want for _, want in BY_HAND]


def test_every_word_stays_once_and_in_order(spark):
    r = random.Random(3)
    plain = [x for x in LINES if x.strip() and not x.startswith(("Page", "TITRE", "Titre", "CHAPITRE", "Section", "SECTION", "Art", "- ", "•", "a)", "12."))]
    pages = ["\n".join(r.choice([*plain, ""]) for _ in range(r.randint(1, 30))) for _ in range(60)]
    for i, own in blocks(spark, pages).items():
        assert all(kind == "paragraphe" for kind, _, _ in own)
        assert " ".join(text for _, _, text in own).split() == pages[i].split()


def test_fusion_chains_across_pages(spark):
    rows = [(1, 1, 0, "paragraphe", "Un début de phrase qui est bien assez long pour rester", ""), (1, 2, 0, "paragraphe", "et sa suite", ""), (1, 2, 1, "paragraphe", "puis sa fin.", ""), (1, 2, 2, "paragraphe", "Autre", ""), (1, 3, 0, "article", "x", "Article 1"), (1, 3, 1, "paragraphe", "court", "")]
    got = structure.fused(spark.createDataFrame(rows, "doc int, page int, block_no int, kind string, text string, mark string")).orderBy("block_no").collect()
    assert [(r["kind"], r["text"], r["page"]) for r in got] == [("paragraphe", "Un début de phrase qui est bien assez long pour rester et sa suite puis sa fin.", 1), ("paragraphe", "Autre", 2), ("article", "x", 3), ("paragraphe", "court", 3)]


def test_segments(spark):
    text = "Titre\n=====\n\nPréambule\n\nArticle premier — Objet\n\nCorps un\n\nCorps deux\n\nArticle 2\n\nPas une tête\n\nArticle premier — Encore\n\nfin"
    got = passages.segments(spark.createDataFrame([(1, text), (2, "x" * 901 + "\n\ny")], "doc int, text string")).orderBy("doc", "segment").collect()
    assert [(r["mark"], r["title"], r["anchor"], r["article"], r["body"]) for r in got if r["doc"] == 1] == [
        ("", "", "", False, ["Préambule"]), ("Article premier", "Objet", "article-premier", True, ["Corps un", "Corps deux", "Article 2", "Pas une tête"]), ("Article premier", "Encore", "article-premier-2", True, ["fin"]),
    ]
    assert [len(r["body"][0]) for r in got if r["doc"] == 2] == [901, 1]
