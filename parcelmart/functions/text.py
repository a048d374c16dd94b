"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of letters/digits, and runs of everything else: a word starts after any non-alphanumeric.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def _upper_letter(letter: Column) -> Column:
    """One letter for one letter: a letter whose upper case needs two (such as the German sharp s) stays."""
    return F.when(F.length(F.upper(letter)) == F.length(letter), F.upper(letter)).otherwise(letter)


def capitalise_words(text: Column) -> Column:
    """PostgreSQL-style INITCAP. Spark's ``initcap`` starts words after white space only."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(_WORD_OR_GAP), F.lit(1))
    capitalised = F.transform(
        pieces,
        lambda piece: F.concat(_upper_letter(piece.substr(1, 1)), piece.substr(F.lit(2), F.length(piece))),
    )
    return F.array_join(capitalised, "")


def place_name(text: Column) -> Column:
    return capitalise_words(F.trim(text))


def state_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
