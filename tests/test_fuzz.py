"""Key expressions against the relational parser on random words."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moniker.functions import cas_key, formula_clean, formula_expand, formula_key, formula_reject, formula_tokens, rubbish_reason
from workload import oracles

PIECES = """H O Na C Fe Cl X Ac b e é 中 É ( ) (OH)2 (CH)3 ((NO)2 (O)0 (I) (IV) 1 0 2 12 60 100 0.5 1.5 .5 2-3 - 1-
-2 — ₂ ₁₀ <sub> </sub> <sub>2</sub> / = : + . 0.125 2.675 99.999 1000 ² DMSO N 64-17-5 50-00-0 , ' [""".split()
FORMULAS = "H O Na C Fe Cl (OH)2 (NH)3 2 3 0.5 2-3 4 K".split()


@pytest.mark.parametrize("pieces", [[*PIECES, " ", "\t", "\n"], FORMULAS], ids=["any", "formulas"])
def test_random_words(spark, monkeypatch, pieces):
    rng = random.Random(11)
    words = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 7))) for _ in range(8000)})
    duck = duckdb.connect()
    duck.register("random_words", pd.DataFrame({"word_orig": words}))
    monkeypatch.setitem(oracles._CTES, "words", ([], "SELECT word_orig FROM random_words"))
    stated = oracles._with(
        ["formula_keys", "rejected", "judged", "cas_keys"],
        """SELECT word_orig, formula_keys.key, rejected.reason, judged.reason, cas_keys.key FROM formula_keys
           JOIN rejected USING (word_orig) JOIN judged USING (word_orig) JOIN cas_keys USING (word_orig)""",
    )
    w = F.col("word_orig")
    found = (
        spark.createDataFrame([(word,) for word in words], "word_orig string")
        .repartition(8)
        .withColumn("cleaned", formula_clean(w))
        .withColumn("expanded", formula_expand(F.col("cleaned")))
        .withColumn("tokens", formula_tokens(F.col("expanded")))
        .select(w, formula_key(w), formula_reject(F.col("cleaned"), F.col("expanded"), F.col("tokens")), rubbish_reason(w), cas_key(w))
    )
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in duck.sql(stated).fetchall()}
