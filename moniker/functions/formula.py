"""Chemical formulas as order-free composition keys.

A formula becomes ``z:lower:upper`` parts joined by ``|`` and sorted by atomic
number ``z``, so that every spelling of one composition has the same key. All
steps are column expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moniker.functions.elements import SYMBOLS
from moniker.functions.groups import GROUP_RANGE, GROUPED, finished, group_brackets, run_summary
from moniker.functions.text import let

# Subscripts, em dash and double line, and what they stand for.
TYPOGRAPHY = ("₀₁₂₃₄₅₆₇₈₉—═", "0123456789-=")
# Fixed value: subscript tags that touch a digit, and bracketed valences.
MARKUP_PATTERN = r"</?sub>(?=[0-9])|(?<=[0-9])</?sub>|\(I+\)"
# Fixed value: a formula with one of these is a reaction, a bond or a mixture.
REJECTED_SYMBOLS = r"[/><,≡=×]"
# A formula does not begin or end like this (Ac is acetyl).
REJECTED_START = r"^[:)]"
REJECTED_END = r"(?:[:(]|Ac)\z"

BRACKET_PATTERN = r"\(([A-Za-z]+)\)([0-9]+)"
NUMBER_PATTERN = r"^[0-9]+(?:\.[0-9]+)?\z"
AMOUNT_PATTERN = r"^\s*\+?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)\s*\z"
ELEMENT_PATTERN = r"\p{IsLowercase}+(?:\p{IsUppercase}\p{IsLowercase}*)?|\p{IsUppercase}\p{IsLowercase}*"
BLANK_EDGES = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+\z"

# Nested brackets can ask for 999 * 999 * ... copies, more than a string can hold. Writing them
# out, which is for reading only, gives null beyond this many characters; keys count groups.
LONGEST_TEXT = 1 << 28


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _occurrences(text: Column, piece: Column) -> Column:
    removed = F.length(text) - F.length(F.replace(text, piece, F.lit("")))
    return F.try_divide(removed, F.length(piece))


def formula_clean(word: Column) -> Column:
    """Formula without blanks, subscript markup and typographic variants."""
    spaceless = F.replace(word, F.lit(" "), F.lit(""))
    return F.translate(F.regexp_replace(spaceless, MARKUP_PATTERN, ""), *TYPOGRAPHY)


def formula_expand(cleaned: Column) -> Column:
    """Write out ``(letters)n`` until none is left; null where n has over 3 digits.

    ``formula_key`` does not need the copies, see ``moniker.functions.groups``.

    A round takes the leftmost bracket and rewrites all its copies, so there are
    at most as many rounds as opening brackets; the ``done`` flag ends them early.
    """

    def state(text: Column, done: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(done).alias("done"))

    def expand_once(acc: Column) -> Column:
        text = acc["text"]
        found = F.regexp_extract(text, BRACKET_PATTERN, 0)

        def rewrite(bracket: Column) -> Column:
            letters = F.regexp_extract(bracket, BRACKET_PATTERN, 1)
            digits = F.regexp_extract(bracket, BRACKET_PATTERN, 2)
            copies = F.when(F.length(digits) <= 3, digits.cast("int"))
            written = _occurrences(text, bracket) * F.length(letters) * copies + F.length(text)
            return (
                F.when(bracket == "", state(text, True))
                .when(written <= LONGEST_TEXT, state(F.replace(text, bracket, F.repeat(letters, copies)), False))
                .otherwise(state(F.lit(None).cast("string"), True))
            )

        return F.when(acc["done"], acc).otherwise(let(found, rewrite))

    rounds = F.array_repeat(F.lit(0), F.coalesce(_occurrences(cleaned, F.lit("(")), F.lit(0)).cast("int"))
    return F.aggregate(rounds, state(cleaned, False), lambda acc, _: expand_once(acc), lambda acc: acc["text"])


def formula_tokens(expanded: Column) -> Column:
    """Element symbols, plain numbers and anything with a dash, in order.

    Runs of letters are cut at capitals. Other runs that are neither a number
    nor hold a dash vanish.
    """

    def symbols(letters: Column) -> Column:
        cased = F.regexp_replace(letters, r"[^\p{IsUppercase}\p{IsLowercase}]", "")
        return F.when(cased == "", F.array(F.lit(""))).otherwise(_matches(cased, ELEMENT_PATTERN))

    def tokens(run: Column) -> Column:
        plain = F.regexp_replace(run, BLANK_EDGES, "")
        return (
            F.when(run.rlike(r"^\p{L}"), symbols(run))
            .when(plain.rlike(NUMBER_PATTERN) | plain.contains("-"), F.array(plain))
            .otherwise(F.array().cast("array<string>"))
        )

    return F.flatten(F.transform(_matches(expanded, r"\p{L}+|\P{L}+"), tokens))


def formula_reject(cleaned: Column, expanded: Column, tokens: Column) -> Column:
    """Why the text is not taken for a formula, or null if it may be one."""

    def plain_number(token: Column) -> Column:
        return F.when(token.rlike(NUMBER_PATTERN), token.try_cast("double"))

    last = F.try_element_at(tokens, F.lit(-1))
    repeated = F.exists(
        F.transform(tokens, lambda t, i: (t == F.get(tokens, i + 1)) & (t != "O")),
        lambda same: F.coalesce(same, F.lit(False)),
    )
    lone_carbon = (F.size(tokens) == 2) & (F.get(tokens, F.lit(0)) == "C")
    return (
        F.when(cleaned.rlike(REJECTED_SYMBOLS), "symbol")
        .when(expanded.isNull(), "expansion")
        .when(expanded.rlike(REJECTED_START) | expanded.rlike(REJECTED_END), "edge")
        .when(F.length(F.replace(expanded, F.lit("("), F.lit("")))
              != F.length(F.replace(expanded, F.lit(")"), F.lit(""))), "brackets")
        .when(F.size(tokens) == 0, "empty")
        .when(last.isin("1", "0"), "last")
        .when(repeated, "repeat")
        .when(lone_carbon & (plain_number(F.get(tokens, F.lit(1))) < 50), "carbon")
        .when(F.exists(tokens, lambda t: F.coalesce(plain_number(t) >= 100, F.lit(False))), "large")
    )


def _bounds(token: Column) -> Column:
    """Lower and upper amount of a number or range token, null for a symbol."""
    parts = F.split(token, "-")

    def amount(part: Column) -> Column:
        return F.regexp_replace(part, r"[\s_]", "").try_cast("double")

    numeric = F.forall(parts, lambda p: p.rlike(AMOUNT_PATTERN))
    first, last = amount(F.get(parts, F.lit(0))), amount(F.element_at(parts, -1))
    return F.when(numeric, F.struct(first.alias("lower"), last.alias("upper")))


def _rendered(z: Column, lower: Column, upper: Column) -> Column:
    return F.concat_ws(":", z.cast("string"), lower, upper)


def _composition(tokens: Column, counts: Column) -> Column:
    """Key of a token list; null if it holds anything that is no element.

    ``counts``, by atomic number or empty, are of elements that take no amount.
    """
    one = F.struct(F.lit(1.0).alias("lower"), F.lit(1.0).alias("upper"))

    def factor(lead: Column) -> Column:
        ratio = F.coalesce(F.try_divide(lead["lower"], lead["upper"]), F.lit(0.0))
        return F.when(lead.isNull(), 1.0).when(lead["lower"] == lead["upper"], lead["lower"]).otherwise(ratio)

    def entries(parsed: Column) -> Column:
        # A symbol takes the amount that follows it, else 1. An empty symbol
        # (a run of letters without case) counts only if an amount follows.
        paired = F.transform(
            parsed,
            lambda p, i: F.struct(
                p["token"].alias("symbol"),
                p["bounds"].isNotNull().alias("is_amount"),
                F.get(parsed, i + 1)["bounds"].alias("follows"),
            ),
        )
        symbols = F.filter(
            paired, lambda e: ~e["is_amount"] & ((e["symbol"] != "") | e["follows"].isNotNull())
        )
        def counted(by: Column) -> Column:
            rows = F.transform(counts, lambda n, i: F.struct((i + 1).cast("long").alias("z"), (by * n).alias("lower"), (by * n).alias("upper")))
            return F.filter(rows, lambda e: F.get(counts, (e["z"] - 1).cast("int")) > 0)

        return let(
            factor(F.get(parsed, F.lit(0))["bounds"]),
            lambda by: F.concat(counted(by), F.transform(
                symbols,
                lambda e: let(
                    F.coalesce(e["follows"], one),
                    lambda a: F.struct(
                        F.array_position(F.split(F.lit(" ".join(SYMBOLS)), " "), e["symbol"]).alias("z"),
                        (by * a["lower"]).alias("lower"),
                        (by * a["upper"]).alias("upper"),
                    ),
                ),
            )),
        )

    def total(rows: Column, z: Column, side: str) -> Column:
        of_element = F.filter(rows, lambda e: e["z"] == z)
        summed = F.aggregate(of_element, F.lit(0.0), lambda acc, e: acc + e[side])
        return F.call_function("format_number", summed, F.lit("0.00"))

    def key(rows: Column) -> Column:
        numbers = F.array_sort(F.array_distinct(F.transform(rows, lambda e: e["z"])))
        parts = F.transform(numbers, lambda z: _rendered(z, total(rows, z, "lower"), total(rows, z, "upper")))
        return F.when((F.size(rows) > 0) & ~F.exists(rows, lambda e: e["z"] == 0), F.array_join(parts, "|"))

    parsed = F.transform(tokens, lambda t: F.struct(t.alias("token"), _bounds(t).alias("bounds")))
    return let(parsed, lambda p: let(entries(p), key))


def _grouped_key(cleaned: Column, grouped: Column) -> Column:
    """Key of a text in which characters may stand for groups.

    A run of letters with a group shows its first and last symbol to the rules; all symbols before the last
    are counted, and the last takes the amount that follows it.
    """
    runs = F.regexp_extract_all(grouped["text"], F.lit(rf"[\p{{L}}{GROUP_RANGE}]+|[^\p{{L}}{GROUP_RANGE}]+"), F.lit(0))
    no_counts = F.array().cast("array<double>")

    def told(run: Column) -> Column:
        def summed(s: Column) -> Column:
            tokens = F.when(s["before"].isNull(), F.array(s["last"])).otherwise(F.array(s["first"], F.lit("*"), s["last"]))
            return F.struct(tokens.alias("tokens"), F.array(s["last"]).alias("open"), s["counts"].alias("counts"), (s["repeats"] | s["odd"]).alias("flawed"))

        def flat(tokens: Column) -> Column:
            return F.struct(tokens.alias("tokens"), tokens.alias("open"), no_counts.alias("counts"), F.lit(False).alias("flawed"))

        group = let(finished(run_summary(run, grouped["groups"])), summed)
        return F.when(run.rlike(GROUPED), group).otherwise(let(formula_tokens(run), flat))

    def edges(parts: Column) -> Column:
        """For the rules about both ends: the text with stars for groups, and with the last symbol where it ends with one."""
        last = F.coalesce(F.get(F.try_element_at(parts, F.lit(-1))["open"], F.lit(0)), F.lit(""))
        starred = F.array_join(F.transform(runs, lambda r: F.when(r.rlike(GROUPED), "*").otherwise(r)), "")
        ended = F.when(F.try_element_at(runs, F.lit(-1)).rlike(GROUPED), F.concat(starred, last)).otherwise(starred)
        return F.when(F.size(grouped["groups"]) == 0, grouped["text"]).otherwise(ended)

    def key(parts: Column) -> Column:
        flawed = F.exists(parts, lambda p: F.coalesce(p["flawed"], F.lit(True)))
        tokens = F.flatten(F.transform(parts, lambda p: p["tokens"]))
        reason = let(F.struct(tokens.alias("tokens"), edges(parts).alias("edges")), lambda x: formula_reject(cleaned, x["edges"], x["tokens"]))
        grouped_parts = F.filter(parts, lambda p: F.size(p["counts"]) > 0)
        plus = lambda acc, p: F.when(F.size(acc) == 0, p["counts"]).otherwise(F.zip_with(acc, p["counts"], lambda a, b: a + b))
        counts = F.aggregate(grouped_parts, no_counts, plus)
        opened = F.flatten(F.transform(parts, lambda p: p["open"]))
        return F.when(~flawed & reason.isNull(), let(counts, lambda c: _composition(opened, c)))

    return let(F.transform(runs, told), key)


def formula_key(word: Column) -> Column:
    """Composition key of a formula, or null if the word is not one.

    Most words fall at the first test: every element has a capital and none has
    two small letters in a row, except inside a bracket that is taken 0 times. Large
    bracket groups are counted, not written out.
    """

    def parse(cleaned: Column) -> Column:
        plausible = cleaned.rlike("[A-Z]") & (~cleaned.rlike("[a-z][a-z]") | cleaned.contains(")0"))
        allowed = plausible & ~cleaned.rlike(REJECTED_SYMBOLS)
        return F.when(allowed, let(group_brackets(cleaned), lambda g: _grouped_key(cleaned, g)))

    return let(formula_clean(word), parse)


def composition_key(elements: Column) -> Column:
    """The same key from dictionary rows of ``(element, upper, lower)`` text.

    Incomplete rows are left out and the last row of an element wins; a
    composition without any row gives null.
    """
    complete = F.filter(elements, lambda e: e.isNotNull())

    def last_of_each(rows: Column) -> Column:
        return F.filter(
            rows,
            lambda e, i: ~F.exists(F.slice(rows, i + 2, F.size(rows)), lambda later: later["element"] == e["element"]),
        )

    def key(rows: Column) -> Column:
        ordered = F.array_sort(
            F.transform(
                rows,
                lambda e: F.struct(
                    e["element"].try_cast("int").alias("z"), e["element"], e["lower"], e["upper"]
                ),
            )
        )
        parts = F.transform(ordered, lambda e: _rendered(e["element"], e["lower"], e["upper"]))
        return F.when(F.size(rows) > 0, F.array_join(parts, "|"))

    return let(let(complete, last_of_each), key)
