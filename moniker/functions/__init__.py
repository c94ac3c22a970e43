"""Lookup keys and predicates as native column expressions."""

from moniker.functions.cas import cas_key
from moniker.functions.formula import (
    composition_key,
    formula_clean,
    formula_expand,
    formula_key,
    formula_reject,
    formula_tokens,
)
from moniker.functions.rubbish import is_rubbish, rubbish_reason
from moniker.functions.text import strip_tags

__all__ = [
    "cas_key",
    "composition_key",
    "formula_clean",
    "formula_expand",
    "formula_key",
    "formula_reject",
    "formula_tokens",
    "is_rubbish",
    "rubbish_reason",
    "strip_tags",
]
