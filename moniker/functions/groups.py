"""Bracket groups of formulas counted instead of written out.

``(letters)n`` stands for n copies of its letters. Few copies are written out; for more a
summary of the copies is kept, and one character of a private range, which letters never
are, stands for it in the text. A summary says all that a key needs of a run of letters however long:

* ``lead``: small letters before the first capital; they belong to the symbol before the run;
* ``first``, ``before`` and ``last`` symbol; the last is open, as small letters may follow it,
  and so does the amount that follows it;
* ``counts``: how often each element is among the symbols before the last;
* ``repeats``: whether two symbols side by side are equal, which only O may be;
* ``odd``: whether a symbol is no element.

Summaries of neighbours are joined, and the counts of n copies follow from those of two and
three. So brackets in brackets cost their own length, whatever their numbers multiply to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moniker.functions.elements import SYMBOLS
from moniker.functions.text import let

# Two private planes: one character for each group of a word.
FIRST_GROUP = 0xF0000
GROUP_RANGE = r"\x{F0000}-\x{10FFFD}"
GROUPED = f"[{GROUP_RANGE}]"
BRACKET_PATTERN = rf"\(([A-Za-z{GROUP_RANGE}]+)\)([0-9]+)"
PIECE_PATTERN = rf"[{GROUP_RANGE}]|\p{{IsLowercase}}+|\p{{IsUppercase}}\p{{IsLowercase}}*"
WRITTEN = 64

SUMMARY = "struct<lead:string,first:string,before:string,last:string,counts:array<double>,repeats:boolean,odd:boolean>"


def _number(symbol: Column) -> Column:
    """Atomic number, 0 for what is no element."""
    return F.array_position(F.split(F.lit(" ".join(SYMBOLS)), " "), symbol)


def _summary(lead: Column, first: Column, before: Column, last: Column, counts: Column, repeats: Column, odd: Column) -> Column:
    names = ["lead", "first", "before", "last", "counts", "repeats", "odd"]
    columns = [lead, first, before, last, counts, repeats, odd]
    return F.struct(*(c.alias(n) for c, n in zip(columns, names, strict=True)))


def _letters(piece: Column) -> Column:
    """Summary of one symbol, or of small letters."""
    none = F.lit(None).cast("string")
    small = piece.rlike(r"^\p{IsLowercase}")
    symbol = F.when(~small, piece)
    return _summary(F.when(small, piece).otherwise(""), symbol, none, symbol, no_counts(), F.lit(False), F.lit(False))


def no_counts() -> Column:
    return F.array_repeat(F.lit(0.0), len(SYMBOLS))


def _closed(left: Column, more: Column) -> Column:
    """``left`` with ``more`` small letters after its last symbol, which is then counted: a summary whose last symbol is the one before."""

    def count(symbol: Column) -> Column:
        z = _number(symbol)
        same = (symbol == left["before"]) & (symbol != "O")
        only = left["before"].isNull()
        return _summary(
            left["lead"],
            F.when(only, symbol).otherwise(left["first"]),
            symbol,
            symbol,
            F.transform(left["counts"], lambda n, i: n + F.when(i + 1 == z, 1.0).otherwise(0.0)),
            left["repeats"] | F.coalesce(same, F.lit(False)),
            left["odd"] | (z == 0),
        )

    return let(F.concat(left["last"], more), count)


def joined(left: Column, right: Column) -> Column:
    """Summary of one run of letters followed by another."""

    def after(closed: Column) -> Column:
        # The second symbol of the right side is told by its ``before`` only where it has two; a
        # right side of one symbol leaves it open.
        single = right["before"].isNull()
        meets = F.when(single, F.lit(False)).otherwise((closed["last"] == right["first"]) & (right["first"] != "O"))
        return _summary(
            closed["lead"],
            closed["first"],
            F.when(single, closed["last"]).otherwise(right["before"]),
            right["last"],
            F.zip_with(closed["counts"], right["counts"], lambda a, b: a + b),
            closed["repeats"] | right["repeats"] | meets,
            closed["odd"] | right["odd"],
        )

    longer = F.concat(left["last"], right["lead"])
    extended = _summary(
        left["lead"],
        F.when(left["before"].isNull(), longer).otherwise(left["first"]),
        left["before"], longer, left["counts"], left["repeats"], left["odd"],
    )
    led = _summary(
        F.concat(left["lead"], right["lead"]),
        right["first"], right["before"], right["last"], right["counts"], right["repeats"], right["odd"],
    )
    return (
        F.when(left["last"].isNull(), led)
        .when(right["last"].isNull(), extended)
        .otherwise(let(_closed(left, right["lead"]), after))
    )


def finished(run: Column) -> Column:
    """The summary with the test of its last two symbols; small letters before the first capital are no element."""
    same = F.coalesce((run["last"] == run["before"]) & (run["last"] != "O"), F.lit(False))
    odd = run["odd"] | (run["lead"] != "") | run["last"].isNull()
    return _summary(run["lead"], run["first"], run["before"], run["last"], run["counts"], run["repeats"] | same, odd)


def run_summary(letters: Column, groups: Column, times: Column | None = None) -> Column:
    """Summary of a run of letters and group characters, taken ``times`` times; null for none."""
    pieces = F.regexp_extract_all(letters, F.lit(PIECE_PATTERN), F.lit(0))

    def own(piece: Column) -> Column:
        index = F.ascii(piece) - F.lit(FIRST_GROUP)
        return F.when(piece.rlike(GROUPED), F.get(groups, index)).otherwise(_letters(piece))

    empty = F.lit(None).cast(SUMMARY)

    def step(acc: Column, piece: Column) -> Column:
        return let(own(piece), lambda s: F.when(acc.isNull(), s).otherwise(joined(acc, s)))

    repeated = pieces if times is None else F.flatten(F.array_repeat(pieces, times))
    return F.aggregate(repeated, empty, step)


def copies(letters: Column, groups: Column, n: Column) -> Column:
    """Summary of ``n`` copies, n at least 2. Small letters alone are no element from three on, however many there are."""

    def many(told: Column) -> Column:
        two, three = F.get(told, F.lit(0)), F.element_at(told, -1)
        counts = F.zip_with(two["counts"], three["counts"], lambda a, b: a + (n - 2) * (b - a))
        return three.withField("counts", counts)

    times = F.sequence(F.lit(2), F.least(n, F.lit(3)))
    return let(F.transform(times, lambda k: run_summary(letters, groups, k)), many)


def group_brackets(cleaned: Column) -> Column:
    """``(text, groups)``: the text with no ``(letters)n`` left, and the groups its characters stand for.

    A null text is an expression whose n has over three digits. A round takes the leftmost
    bracket with all its copies, as writing out does.
    """
    none = F.array().cast(f"array<{SUMMARY}>")

    def state(text: Column, groups: Column, done: bool) -> Column:
        return F.struct(text.alias("text"), groups.alias("groups"), F.lit(done).alias("done"))

    def once(acc: Column) -> Column:
        text, groups = acc["text"], acc["groups"]

        def rewrite(bracket: Column) -> Column:
            letters = F.regexp_extract(bracket, BRACKET_PATTERN, 1)
            digits = F.regexp_extract(bracket, BRACKET_PATTERN, 2)
            n = F.when(F.length(digits) <= 3, digits.cast("int"))
            short = (n < 2) | (n * F.length(letters) <= WRITTEN)
            name = F.decode(F.unhex(F.lpad(F.hex(F.size(groups) + F.lit(FIRST_GROUP)), 8, "0")), "UTF-32")
            grouped = F.array_append(groups, copies(letters, groups, n))
            return (
                F.when(bracket == "", state(text, groups, True))
                .when(n.isNull(), state(F.lit(None).cast("string"), groups, True))
                .when(short, state(F.replace(text, bracket, F.repeat(letters, n)), groups, False))
                .otherwise(state(F.replace(text, bracket, name), grouped, False))
            )

        return F.when(acc["done"], acc).otherwise(let(F.regexp_extract(text, BRACKET_PATTERN, 0), rewrite))

    brackets = F.length(cleaned) - F.length(F.replace(cleaned, F.lit("("), F.lit("")))
    rounds = F.array_repeat(F.lit(0), F.coalesce(brackets, F.lit(0)).cast("int"))
    # A character of the private range that is in the word already is no letter and no number.
    plain = F.regexp_replace(cleaned, GROUPED, "¤")
    return F.aggregate(rounds, state(plain, none, False), lambda acc, _: once(acc))
