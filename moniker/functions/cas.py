"""CAS registry numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

CAS_PATTERN = r"^[0-9]{2,7}-[0-9]{2}-[0-9]\z"
# Digits before the check digit, at most.
BODY_DIGITS = 9


def check_digit(body: Column) -> Column:
    """Sum of the digits of ``body``, each times its place from the right, modulo 10."""
    places = range(1, BODY_DIGITS + 1)
    return reduce(add, (F.call_function("div", body, F.lit(10 ** (i - 1))) % 10 * i for i in places)) % 10


def cas_key(word: Column) -> Column:
    """The registry number without dashes, or null if form or check digit is wrong.

    The digits are taken from the right where the form puts them, without a lambda, so that Spark
    compiles the rule; it is tried on mentions.
    """

    def digit(place: int) -> Column:
        """The digit at a place from the right, 0 before the first."""
        return F.greatest(F.ascii(F.substring(word, -place, 1)) - F.lit(ord("0")), F.lit(0))

    body = [3, 4, *range(6, 6 + BODY_DIGITS - 2)]
    check = reduce(add, (digit(place) * i for i, place in enumerate(body, start=1))) % 10
    number = F.replace(word, F.lit("-"), F.lit("")).cast("bigint")
    return F.when(word.rlike(CAS_PATTERN) & (check == digit(1)), number)
