"""Small building blocks shared by the key expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the markup that is taken out of dictionary names. Tags with
# blanks between attributes are outside the pattern and stay.
TAG_PATTERN = r"""</?[a-zA-Z0-9"',=-]+/?>"""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    Plain reuse of a column object copies its whole expression tree to every
    place of use; the parameter of a one-element ``transform`` is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_tags(text: Column) -> Column:
    """Name without markup; empty or missing text gives null, which never matches."""
    return F.regexp_replace(F.nullif(text, F.lit("")), TAG_PATTERN, "")
