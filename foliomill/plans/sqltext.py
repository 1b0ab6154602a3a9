"""Pieces of DuckDB SQL that several queries share."""

from ..functions.text import QUESTION_WORDS, STOP_WORDS


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(strip_accents(coalesce({text}, ''))), '[^a-z0-9]+'), lambda t: length(t) >= 2)"


def words(own: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(own)))


STOP, QUESTION = words(STOP_WORDS), words(STOP_WORDS + QUESTION_WORDS)
