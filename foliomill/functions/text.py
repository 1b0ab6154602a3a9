"""Column functions for text, titles, dates and numbers.  All stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists, names and formats that results depend on.
STOP_WORDS = (
    "au aux avec ce ces dans de des du elle en et eux il ils je la le les leur lui ma mais me meme mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se "
    "ses son sur ta te tes toi ton tu un une vos votre vous c d j l a m n s t y ete etee etees etes etant suis es est sommes etes sont serai seras sera serons serez "
    "seront serais serait serions seriez seraient etais etait etions etiez etaient fus fut fumes futes furent sois soit soyons soyez soient fusse fusses fut ai as "
    "avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions auriez auraient avais avait avions aviez avaient eus eut eumes eutes eurent aie aies "
    "ait ayons ayez aient eusse eusses eut eussions eussiez eussent ayant eu eue eues plus tres etre avoir cette cet celui celle ceux dont donc alors ainsi comme "
    "lorsque apres avant entre sous vers chez sans selon dit dite dits dites"
).split()
QUESTION_WORDS = (
    "quel quels quelle quelles lequel laquelle lesquels lesquelles quoi quand comment pourquoi combien peut peuvent doit doivent faut puis peux dois dire disent dis "
    "prevoit prevoient prevu prevue prevus prevues dispose disposent stipule stipulent enonce enoncent regit regissent definit definissent signifie concernant concerne "
    "concernent existe texte textes document documents recueil corpus site liste svp stp merci bonjour bonsoir salut"
).split()
MONTHS = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()
TITLE_ACCENTS = (
    "Décision Marché Régional Développement Boursière Étude Opérations Financières Financière Comité Réunion Journée Références Agrément Irrégulière Présidence Visé "
    "Épargne Sociétés Intermédiation Générale Général Règlement Dépositaire Conformité Règles Activités Continuité Émission Sécurisées Entités Maîtres "
    "Proportionnalité Réglementation"
).split()
TITLE_ACRONYMS = "AMF-UMOA UMOA UEMOA CREPMF BRVM SGI DC/BR OPCVM OPC IFRS SUKUK BCEAO CFA TCC SGO APE MFR OHADA LBC AMF".split()
# End of fixed values.

SPACES = r"(?U)\s"


@cache
def _folding() -> tuple[str, str]:
    """Latin letters that decompose into a base letter and marks, and those base letters."""
    pairs = []
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != chr(c):
            pairs.append((chr(c), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def unaccent(text: Column) -> Column:
    """Drop diacritics; letters that don't decompose (œ, æ, ß) stay."""
    return F.regexp_replace(F.translate(text, *_folding()), r"\p{Mn}+", "")


def normalised(text: Column) -> Column:
    """Lower case without accents, typographic apostrophes as plain ones."""
    return F.lower(unaccent(F.translate(text, "’‘ʼ", "'''")))


def tokens(text: Column, least: int = 2) -> Column:
    """Runs of a-z and 0-9 of the normalised text, of least characters or more, in order."""
    return F.filter(F.split(F.lower(unaccent(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", -1), lambda t: F.length(t) >= least)


def words_array(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


def without(tokens_: Column, words: list[str]) -> Column:
    """Tokens that aren't in the list, repeats and order kept."""
    own = sorted(set(words))
    return F.filter(tokens_, lambda t: ~t.isin(*own))


def bearing(tokens_: Column) -> Column:
    """Words that bear a question's meaning: neither stop nor question words; if none is left, all but stop words."""
    strict = without(tokens_, STOP_WORDS + QUESTION_WORDS)
    return F.when(F.size(strict) > 0, strict).otherwise(without(tokens_, STOP_WORDS))


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, rf"{SPACES}+$|^{SPACES}+", "")


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"{SPACES}+", " "))


def slug(text: Column, most: int = 90) -> Column:
    plain = F.lower(unaccent(F.translate(F.coalesce(text, F.lit("")), "’°", "'")))
    return F.substring(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


def capitalised(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def clean_title(text: Column) -> Column:
    """A title in capitals made readable: sentence case, accents and acronyms put back, references after n° in capitals; other titles only collapsed."""
    flat = collapsed(F.coalesce(text, F.lit("")))
    letters = F.length(F.regexp_replace(flat, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(flat, r"[^\p{Lu}]+", ""))
    out = capitalised(flat)
    for word in TITLE_ACCENTS:
        bare = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if unicodedata.category(c) != "Mn")
        out = F.regexp_replace(out, rf"(?U)\b{bare}\b", word.lower())
        out = F.regexp_replace(out, rf"(?U)\b{bare.capitalize()}\b", word)
    for name in TITLE_ACRONYMS:
        out = F.regexp_replace(out, rf"(?iU)\b{name.lower()}\b", name)
    out = F.regexp_replace(out, r"(?iU)\bn\s*°\s*", "n° ")
    parts = F.split(out, r"(?=n° [0-9a-z])", -1)  # each piece after the first starts with a mark and its reference
    mark = r"^(n° )([0-9a-z][0-9a-z/\-.]*)"
    shown = F.transform(parts, lambda p: F.when(p.rlike(mark), F.concat(F.lit("n° "), F.upper(F.regexp_extract(p, mark, 2)), F.regexp_replace(p, mark, ""))).otherwise(p))
    return F.when((letters > 0) & (upper > 0.85 * letters), F.array_join(shown, "")).otherwise(flat)


def title_reference(title: Column) -> Column:
    tight = F.regexp_replace(F.coalesce(title, F.lit("")), rf"{SPACES}*/{SPACES}*", "/")
    return F.regexp_replace(F.regexp_extract(tight, r"(?iU)n\s*°\s*([0-9A-Z][0-9A-Za-z/\-.]*)", 1), r"[.\-/]+$", "")


def title_number(title: Column) -> Column:
    return F.regexp_extract(title_reference(title), r"^(\d{1,3})", 1)


def title_year(title: Column) -> Column:
    """Last four-digit year of the reference, else of the title; else the reference's two-digit suffix, 90 and up in the last century."""
    tight = F.regexp_replace(F.coalesce(title, F.lit("")), rf"{SPACES}*/{SPACES}*", "/")
    reference = title_reference(title)
    years = lambda t: F.regexp_extract_all(t, F.lit(r"(?<![0-9])((?:19|20)\d{2})"), F.lit(1))
    last = lambda a: F.when(F.size(a) > 0, F.element_at(a, -1))
    short = F.regexp_extract(reference, r"[/\-](\d{2})[A-Za-z]*$", 1)
    pivot = F.when(short != "", F.when(short.cast("int") >= 90, F.concat(F.lit("19"), short)).otherwise(F.concat(F.lit("20"), short)))
    return F.coalesce(last(years(reference)), last(years(tight)), pivot, F.lit(""))


def effective_year(year: Column, iso_date: Column) -> Column:
    return F.coalesce(F.nullif(year, F.lit("")), F.substring(iso_date, 1, 4), F.lit(""))


def french_date(iso: Column) -> Column:
    """"1er janvier 2022"; empty where the value isn't a date."""
    part = lambda i: F.regexp_extract(F.substring(F.coalesce(iso, F.lit("")), 1, 10), r"^(\d+)-(\d+)-(\d+)$", i).try_cast("int")
    day = F.when(part(3) == 1, F.lit("1er")).otherwise(part(3).cast("string"))
    month = F.try_element_at(words_array(MONTHS), F.when(part(2).between(1, 12), part(2)))
    return F.coalesce(F.concat(day, F.lit(" "), month, F.lit(" "), part(1).cast("string")), F.lit(""))


def roman_value(text: Column) -> Column:
    """premier, digits or a Roman numeral as a number; null otherwise."""
    t = F.upper(stripped(text))
    value = lambda c: F.element_at(F.create_map(*[F.lit(x) for k, v in zip("IVXLC", (1, 5, 10, 50, 100), strict=True) for x in (k, v)]), c)
    chars = F.transform(F.split(t, ""), value)
    total = F.aggregate(F.reverse(chars), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("right")), lambda acc, v: F.struct((acc["sum"] + F.when(v < acc["right"], -v).otherwise(v)).cast("int").alias("sum"), v.cast("int").alias("right")))
    return F.when(t == "PREMIER", 1).when(t.rlike(r"^\d+$"), t.try_cast("int")).when(t.rlike("^[IVXLC]+$"), total["sum"])


def roman_repaired(raw: Column) -> Column:
    """1 and l read for I in a numeral that has a Roman letter; upper case."""
    t = stripped(raw)
    return F.upper(F.when(t.rlike("^[IVXLCivxlc1l]+$") & t.rlike("[IVXCivxcl]"), F.translate(t, "1l", "II")).otherwise(t))


def escaped_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def padded(text: Column, width: int = 8) -> Column:
    """Zeros on the left; longer values are not cut."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def thousands(number: Column) -> Column:
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit(" "))


def typographic(text: Column) -> Column:
    """Recognised text put right: line ends, hyphenation, ordinals, numerals read as a bar, spaces, quotes, apostrophes."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    for pattern, by in (
        (r"([A-ZÀ-Ö0-9])-\n([A-ZÀ-Ö])", "$1-$2"),
        ("([a-zà-öø-ÿ])[-­]\n([a-zà-öø-ÿ])", "$1$2"),
        (r"(?U)\b1\s*[“”″]", "1er"),
        (r"(?Um)^\|(\s*[-–—.)])", "I$1"),
        (r"[ \t]{2,}", " "),
        (r"\n{3,}", "\n\n"),
        ("''|``", '"'),
        (r"(?U)(?<=\w)'(?=\w)", "’"),
        (r"(?U)[^\S\n]+(?=\n|$)", ""),
    ):
        out = F.regexp_replace(out, pattern, by)
    return stripped(out)


def dotted_cleaned(line: Column) -> Column:
    """Words of 20 letters or more in which one letter comes six times or more are dotted leaders: an ellipsis."""
    word = r"(?U)\b[A-Za-zÀ-ÿ]{20,}\b"
    found = F.array_distinct(F.regexp_extract_all(line, F.lit(f"({word})"), F.lit(1)))
    leader = F.filter(found, lambda w: F.array_max(F.transform(F.array_distinct(F.split(F.lower(w), "")), lambda c: F.length(w) - F.length(F.replace(F.lower(w), c)))) >= 6)
    return F.aggregate(leader, line, lambda acc, w: F.regexp_replace(acc, F.concat(F.lit(r"(?U)\b"), w, F.lit(r"\b")), F.lit("…")))


def numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("long"))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value worked out once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def snippet(text: Column, words: Column, before: int = 130, after: int = 230) -> Column:
    """Text around the earliest of the words, white space collapsed, ellipses where it is cut; null without a hit."""

    def shown(first: Column) -> Column:
        begin = F.greatest(first["at"] - 1 - before, F.lit(0))
        end = F.least(F.length(text), first["at"] - 1 + first["n"] + after)
        body = collapsed(F.substring(text, begin + 1, end - begin))
        return F.when(first.isNotNull(), F.concat(F.when(begin > 0, "… ").otherwise(""), body, F.when(end < F.length(text), " …").otherwise("")))

    hits = lambda plain: F.array_min(F.filter(F.transform(words, lambda w: F.struct(F.call_function("instr", plain, w).alias("at"), F.length(w).alias("n"))), lambda h: h["at"] > 0))
    return let(let(normalised(text), hits), shown)


def highlighted(text: Column, words: Column, least: int = 1) -> Column:
    """Every hit of the words, accents ignored, in <mark>; overlapping and adjacent hits are one; the rest is escaped."""
    plain = normalised(text)
    own = F.filter(words, lambda w: F.length(w) >= least)

    def places(w: Column) -> Column:
        gaps = F.split(plain, F.concat(F.lit(r"\Q"), w, F.lit(r"\E")), F.lit(-1))
        ends = F.aggregate(F.slice(gaps, 1, F.size(gaps) - 1), F.array().cast("array<int>"), lambda acc, g: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)) + F.length(w), F.lit(0)) + F.length(g))))
        return F.transform(ends, lambda e: F.struct(e.alias("begin"), (e + F.length(w)).alias("end")))

    zones = F.array_sort(F.flatten(F.transform(own, places)))
    empty = F.array().cast("array<struct<begin:int,end:int>>")
    merged = F.aggregate(
        zones,
        empty,
        lambda acc, z: F.when(
            (F.size(acc) > 0) & (z["begin"] <= F.try_element_at(acc, F.lit(-1))["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["begin"].alias("begin"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], z["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(z))),
    )
    done = F.aggregate(
        merged,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, z: F.struct(
            F.concat(acc["out"], escaped_html(F.substring(text, acc["at"] + 1, z["begin"] - acc["at"])), F.lit("<mark>"), escaped_html(F.substring(text, z["begin"] + 1, z["end"] - z["begin"])), F.lit("</mark>")).alias("out"),
            z["end"].alias("at"),
        ),
    )
    return F.concat(done["out"], escaped_html(F.substring(text, done["at"] + 1, F.length(text))))
