"""Relational operators of the linking job."""

from moniker.operators.lookup import lookup_keys, lookup_words
from moniker.operators.mentions import flatten_mentions, renest_mentions
from moniker.operators.skew import hot_keys, spread_join

__all__ = [
    "flatten_mentions",
    "hot_keys",
    "lookup_keys",
    "lookup_words",
    "renest_mentions",
    "spread_join",
]
