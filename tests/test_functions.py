"""Every rule on hand-made words with known answers."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from moniker.functions import (
    cas_key,
    composition_key,
    formula_expand,
    formula_key,
    formula_reject,
    formula_tokens,
    is_rubbish,
    rubbish_reason,
    strip_tags,
)
from moniker.functions import groups
from moniker.functions.elements import SYMBOLS

WATER = "1:2.00:2.00|8:1.00:1.00"
FORMULAS = {
    "H2O": WATER,
    "OH2": WATER,
    "H2 O": WATER,
    "H₂O": WATER,
    "H<sub>2</sub>O": WATER,
    "H2 O": WATER,
    "2H2O": "1:4.00:4.00|8:2.00:2.00",
    "Fe(OH)2": "1:2.00:2.00|8:2.00:2.00|26:1.00:1.00",
    "((OH)2Fe)2": "1:4.00:4.00|8:4.00:4.00|26:2.00:2.00",
    "(CH3)2": "1:1.00:1.00|6:1.00:1.00",
    "(C60)": "6:1.00:1.00",
    "FeO1-2": "8:1.00:2.00|26:1.00:1.00",
    "FeO1—2": "8:1.00:2.00|26:1.00:1.00",
    "FeO1-2-3": "8:1.00:3.00|26:1.00:1.00",
    "NaO0-.5": "8:0.00:0.50|11:1.00:1.00",
    "1-2NaCl": "11:0.50:0.50|17:0.50:0.50",
    "1-0NaCl": "11:0.00:0.00|17:0.00:0.00",
    "2-2NaCl": "11:2.00:2.00|17:2.00:2.00",
    "Na0.5Cl0.5": "11:0.50:0.50|17:0.50:0.50",
    "H.5O": "1:1.00:1.00|8:1.00:1.00",
    "Fe(II)O": "8:1.00:1.00|26:1.00:1.00",
    # A valence that is not all I is iodine and vanadium.
    "Fe(IV)O": "8:1.00:1.00|23:1.00:1.00|26:1.00:1.00|53:1.00:1.00",
    "COOH": "1:1.00:1.00|6:1.00:1.00|8:2.00:2.00",
    "C60": "6:60.00:60.00",
    "C100-200": "6:100.00:200.00",
    "BFe": "5:1.00:1.00|26:1.00:1.00",
    # Letters without case vanish next to others and end a list when alone.
    "Fe中": "26:1.00:1.00",
    "Fe1中": "26:1.00:1.00",
    "C12中": "6:12.00:12.00",
    "Fe.中2": None,
    # A bracket taken 0 times.
    "Fe(ab)0": "26:1.00:1.00",
    "F(e)1": "26:1.00:1.00",
    # All copies of a bracket are rewritten at once, also inside one with more
    # digits: this becomes OHOHFeOHOH5.
    "(OH)2Fe(OH)25": "1:8.00:8.00|8:4.00:4.00|26:1.00:1.00",
    # Half to even on the binary value.
    "Fe0.125O": "8:1.00:1.00|26:0.12:0.12",
    "Fe0.135O": "8:1.00:1.00|26:0.14:0.14",
    "Fe2.675O": "8:1.00:1.00|26:2.67:2.67",
}
REJECTED = {
    "C12": "carbon", "C100": "large", "NaNa": "repeat", "HO1": "last", "HO0": "last", "": "empty", "..": "empty",
    "CaAc": "edge", ":H2O": "edge", ")H2O": "edge", "H2O:": "edge", "(H2O": "brackets", "Na=O": "symbol",
    "Na═O": "symbol", "A/B": "symbol", "H₂O,": "symbol", "(OH)1000": "expansion",
}
NOT_ELEMENTS = ["Xx2", "D2O", "aB", "Fe-O", "7", "water", "((((A)999)999)999)999", "O2-", "Inf", "NaN2x"]


def evaluate(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, w {kind}")
    return [r.out for r in frame.select("i", expression(F.col("w")).alias("out")).orderBy("i").collect()]


def test_formula_keys(spark):
    assert dict(zip(FORMULAS, evaluate(spark, FORMULAS, formula_key))) == FORMULAS


def test_no_formula(spark):
    words = [*REJECTED, *NOT_ELEMENTS, None]
    assert evaluate(spark, words, formula_key) == [None] * len(words)


def test_formula_rejections(spark):
    from moniker.functions import formula_clean

    def reason(word):
        cleaned = formula_clean(word)
        expanded = formula_expand(cleaned)
        return formula_reject(cleaned, expanded, formula_tokens(expanded))

    assert dict(zip(REJECTED, evaluate(spark, REJECTED, reason))) == REJECTED


def test_formula_does_not_depend_on_element_order(spark):
    pieces = ["Na2", "Fe3", "O4", "Cl0.5", "H7-8"]
    spelled = ["".join(p) for p in itertools.permutations(pieces)]
    assert set(evaluate(spark, spelled, formula_key)) == {
        "1:7.00:8.00|8:4.00:4.00|11:2.00:2.00|17:0.50:0.50|26:3.00:3.00"
    }


def test_every_element(spark):
    assert len(SYMBOLS) == len(set(SYMBOLS)) == 118
    assert evaluate(spark, [f"{s}2O3" for s in SYMBOLS if s != "O"], formula_key)[:2] == [
        "1:2.00:2.00|8:3.00:3.00",
        "2:2.00:2.00|8:3.00:3.00",
    ]
    # A final Ac is taken for acetyl, so actinium alone has no key.
    expected = [None if s == "Ac" else f"{z}:1.00:1.00" for z, s in enumerate(SYMBOLS, 1)]
    assert evaluate(spark, SYMBOLS, formula_key) == expected


def test_amounts_round_like_printf(spark):
    rng = random.Random(7)
    amounts = [f"{rng.randint(0, 99)}.{rng.randint(0, 9999):04d}" for _ in range(2000)]
    expected = [f"26:{float(a):.2f}:{float(a):.2f}" for a in amounts]
    assert evaluate(spark, [f"Fe{a}" for a in amounts], formula_key) == expected


def test_large_bracket_counts(spark):
    assert evaluate(spark, ["Fe(OH)999"], formula_key) == ["1:999.00:999.00|8:999.00:999.00|26:1.00:1.00"]
    assert evaluate(spark, ["Fe((OH)99Na)99"], formula_key) == [
        "1:9801.00:9801.00|8:9801.00:9801.00|11:99.00:99.00|26:1.00:1.00"
    ]


def test_composition_key(spark):
    rows = [
        [("8", "1.00", "1.00"), ("1", "2.00", "2.00")],
        [("8", "1.00", "1.00"), None, ("1", "3.00", "2.50"), ("8", "9.00", "7.00")],
        [None],
        [],
        [("11", "1.00", "1.00"), ("2", "1.00", "1.00")],
    ]
    kind = "array<struct<element: string, upper: string, lower: string>>"
    assert evaluate(spark, rows, composition_key, kind) == [
        WATER, "1:2.50:3.00|8:7.00:9.00", None, None, "2:1.00:1.00|11:1.00:1.00",
    ]


CAS = {
    "7732-18-5": 7732185, "007732-18-5": 7732185, "64-17-5": 64175, "50-00-0": 50000, "00-00-0": 0,
    "9999999-99-5": 9999999995, "7732-18-4": None, "7732-185": None, "1-23-4": None, "12345678-12-1": None,
    "64-17-5\n": None, " 64-17-5": None, "": None, None: None,
}


def test_cas_keys(spark):
    assert dict(zip(CAS, evaluate(spark, CAS, cas_key))) == CAS


def test_wrong_check_digit_is_never_a_key(spark):
    valid = ["7732-18-5", "64-17-5", "50-00-0", "107-07-3", "7440-23-5"]
    wrong = [f"{v[:-1]}{d}" for v in valid for d in range(10) if str(d) != v[-1]]
    assert None not in evaluate(spark, valid, cas_key)
    assert evaluate(spark, wrong, cas_key) == [None] * len(wrong)


RUBBISH = {
    "N": "single_char", "x": "single_char", "1,2-": "digits", "(2)": "digits", "[3": "digits", "NN": "digits",
    "1.2": "digits", "12-": "digits", "1.": "digits", "-": "single_char", "--": "digits", "1.2.": None, ",1": "digits",
    ",,1": None, "1,,2": "digits", "1,2.3": None, "1'2,3": "digits", "DMSO": "caps", "PCBs": "caps", "PEs": "caps",
    "SUS304": "caps", "PVAc": "caps", "CO": None, "PE": None, "ethanol": None, "H2O": None, "": None, "DMSO\n": None,
}


def test_rubbish_reasons(spark):
    assert dict(zip(RUBBISH, evaluate(spark, RUBBISH, rubbish_reason))) == RUBBISH
    assert evaluate(spark, RUBBISH, is_rubbish) == [r is not None for r in RUBBISH.values()]


def test_digit_rule_on_all_short_words(spark):
    import re

    stated = re.compile(r"([-,'\[\]])?[N0-9)(\[\]-]+([-.,'\[\]])?[N,0-9)(\[\]-]*?")
    words = ["".join(w) for n in range(2, 6) for w in itertools.product("1N-,.'[(x", repeat=n) if "x" not in w[:-1]]
    reasons = evaluate(spark, words, rubbish_reason)
    assert [r == "digits" for r in reasons] == [bool(stated.fullmatch(w)) for w in words]


@pytest.mark.parametrize("word", ["1" * 200_000 + "..", "(" * 50_000 + "A" + ")2" * 50_000])
def test_long_words_take_linear_time(spark, word):
    assert evaluate(spark, [word], rubbish_reason) == [None]


def test_strip_tags(spark):
    tagged = {"<i>a</i>": "a", "H<sub>2</sub>O": "H2O", '<a href="x">b': '<a href="x">b', "a<br/>b": "ab",
              "<b class=x>c": "<b class=x>c", "<b=x>c": "c", "": None, None: None, "<i></i>": "", "a < b > c": "a < b > c"}
    assert dict(zip(tagged, evaluate(spark, tagged, strip_tags))) == tagged


GROUPS = {
    "((HO)999)500Na": "1:499500.00:499500.00|8:499500.00:499500.00|11:1.00:1.00",
    "(((HO)999)999)999Na2": "1:997002999.00:997002999.00|8:997002999.00:997002999.00|11:2.00:2.00",
    "2(CHO)900N": "1:1800.00:1800.00|6:1800.00:1800.00|7:2.00:2.00|8:1800.00:1800.00",
    "1.5(NaCl)100K2-3": "11:150.00:150.00|17:150.00:150.00|19:3.00:4.50",
    "O(O)900O": "8:902.00:902.00",
    "(NaO)500Na": "8:500.00:500.00|11:501.00:501.00",
    "Na(NaO)500": None, "(C)700": None, "H(e)100": None, "(HAc)99": None, "(Ac)99": None, "(H)1000": None, "((O)900)1000": None,
}


def test_groups_of_any_size(spark):
    deep = "(" * 40 + "HO" + ")2" * 40
    assert evaluate(spark, [*GROUPS, deep], formula_key) == [*GROUPS.values(), f"1:{2**40}.00:{2**40}.00|8:{2**40}.00:{2**40}.00"]


@pytest.mark.parametrize("seed", [1, 2])
def test_counted_groups_equal_written_ones(spark, monkeypatch, seed):
    rng = random.Random(seed)
    pieces = "H O Na C Fe Cl X Ac b e \u00c9 ( ) (OH)2 ((NO)2 ((OH)3)2 (HNaO)5 (O)0 )2 )3 )9 (NaC)4 ((NaO)2Cl)3 (eH)3 (bO)2 1 0 2 12 60 0.5 2-3 -".split()
    words = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 7))) for _ in range(4000)})
    monkeypatch.setattr(groups, "WRITTEN", 10**6)
    written = evaluate(spark, words, formula_key)
    monkeypatch.setattr(groups, "WRITTEN", 0)
    assert evaluate(spark, words, formula_key) == written and sum(k is not None for k in written) > 300
