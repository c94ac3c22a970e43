import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VECTORS = "vec_id bigint, embedding array<float>, label int"
# Names that operators use inside, as columns of the input.
CLASHING = ["id", "n", "class", "row", "size", "words", "score", "token", "cuts", "spans", "slice", "name", "vector", "cell"]


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) or (doc_id, text, lang, source) as a table of documents with clashing columns."""

    def made(rows, extra=True):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "a")), len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        return frame.withColumns({c: F.lit("extra") for c in CLASHING}) if extra else frame

    return made
