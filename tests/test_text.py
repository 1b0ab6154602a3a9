import re

import pytest
from pyspark.sql import functions as F

from foliomill.functions import text as T


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("title", "want"),
    [
        ("DECISION N° 12/CREPMF/2010 RELATIVE AU MARCHE REGIONAL", "Décision n° 12/CREPMF/2010 relative au marché régional"),
        ("Instruction déjà lisible n° 3", "Instruction déjà lisible n° 3"),
        ("  L'UEMOA   ET LES SGI ", "L'UEMOA et les SGI"),
        ("", ""),
        (None, ""),
    ],
)
def test_titles(spark, title, want):
    assert one(spark, T.clean_title, title) == [want]


def test_title_parts(spark):
    titles = ["Instruction N°81 / AMF / 2025", "N°41/2009R", "N°02/97", "Circulaire de 2004", "N°13/18.", None]
    assert one(spark, T.title_reference, *titles) == ["81/AMF/2025", "41/2009R", "02/97", "", "13/18", ""]
    assert one(spark, T.title_number, *titles) == ["81", "41", "02", "", "13", ""]
    assert one(spark, T.title_year, *titles) == ["2025", "2009", "1997", "2004", "2018", ""]


def test_dates_and_numerals(spark):
    assert one(spark, T.french_date, "2022-01-01T00:00", "1999-12-31", "2022-13-01", "x", None, "") == ["1er janvier 2022", "31 décembre 1999", "", "", "", ""]
    assert one(spark, T.roman_value, "premier", "12", "XIV", "xcix", "ABC", "") == [1, 12, 14, 99, None, None]
    assert one(spark, T.roman_repaired, "Il", "X1V", "2", "vii") == ["II", "XIV", "2", "VII"]


def test_tokens_slugs_and_folding(spark):
    assert one(spark, T.tokens, "L'Épargne n°12 : œuvre À") == [["epargne", "12", "uvre"]]
    assert one(spark, T.slug, "L’Épargne n° 12 !", None) == ["l-epargne-n-12", ""]
    assert one(spark, T.unaccent, "Ñandú œ ß Ǖ é") == ["Nandu œ ß U e"]
    assert one(spark, lambda c: T.bearing(T.tokens(c)), "quel est le document", "comment agréer une SGI") == [["quel", "document"], ["agreer", "sgi"]]


def test_typographic(spark):
    raw = "la négocia-\ntion du CREPMF-\nUMOA  est le 1” jour\r\n| - suite   \n\n\n\nl'an ''dit''"
    assert one(spark, T.typographic, raw) == ["la négociation du CREPMF-UMOA est le 1er jour\nI - suite\n\nl’an \"dit\""]


def test_dotted(spark):
    assert one(spark, T.dotted_cleaned, "nom eeeeeeeeeeeeeeeeeeeeeeee et anticonstitutionnellement", "rien") == ["nom … et anticonstitutionnellement", "rien"]


def plain_highlight(text, plain, words):
    zones = sorted((m.start(), m.end()) for w in words for m in re.finditer(re.escape(w), plain))
    merged = []
    for a, b in zones:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = "", 0
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("'", "&#x27;")
    for a, b in merged:
        out += esc(text[at:a]) + "<mark>" + esc(text[a:b]) + "</mark>"
        at = b
    return out + esc(text[at:])


def test_highlight(spark):
    for text in ("une station <b>nationale</b> & l'émission", "onon onon", "rien", ""):
        words = ["tion", "on", "emi", "nat"]
        plain = text.replace("é", "e").lower()
        column = lambda c: T.highlighted(c, F.array(*map(F.lit, words)))  # noqa: B023, E731
        assert one(spark, column, text) == [plain_highlight(text, plain, words)]


def test_snippet(spark):
    text = "mot " * 100 + "cible " + "suite " * 100
    got = one(spark, lambda c: T.snippet(c, F.array(F.lit("cible"))), text, "cible seule", "rien")
    assert got[0].startswith("… ") and got[0].endswith(" …") and "cible" in got[0] and got[1:] == ["cible seule", None]
