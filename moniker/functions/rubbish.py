"""Words that are noise rather than the name of a substance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations and formulas in capitals that are real substances,
# and two words that are noise although no pattern says so.
KEPT_CAPITALS = ["PE", "PEEK", "NAFION", "PEDT", "KAPTON", "MYLAR", "CO", "WC", "KOH", "HCN", "WO", "KCN"]
ALWAYS_RUBBISH = ["SUS304", "PVAc"]

# Digits, brackets and the locant N with at most one separator that is neither.
# Possessive runs keep the match linear in the length of the word.
DIGITS_PATTERN = r"^(?:[-,'\[\]])?[N0-9)(\[\]-]++[.']?+[N,0-9)(\[\]-]*+\z"
CAPITALS_PATTERN = r"^[A-Z]+s?\z"


def rubbish_reason(word: Column) -> Column:
    """First rule that calls the word rubbish, or null if none does."""
    capitals = word.isin(ALWAYS_RUBBISH) | (~word.isin(KEPT_CAPITALS) & word.rlike(CAPITALS_PATTERN))
    return (
        F.when(F.length(word) == 1, "single_char")
        .when(word.rlike(DIGITS_PATTERN), "digits")
        .when(capitals, "caps")
    )


def is_rubbish(word: Column) -> Column:
    return rubbish_reason(word).isNotNull()
