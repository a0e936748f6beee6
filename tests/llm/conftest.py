import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Make a documents table from (doc_id, text[, lang, source]) rows, with clashing extra columns."""

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("size", "kept", "n", "class", "code", "word", "part", "score", "row", "m", "bundle", "found", "held_out"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make
