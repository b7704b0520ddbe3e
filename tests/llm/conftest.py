import pytest


@pytest.fixture
def documents(spark):
    """Make a documents table from (doc_id, text[, lang[, source]]) rows."""

    def make(rows, extra=""):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        df = df.selectExpr("*", "cast(length(text) as long) as n_chars")
        return df.selectExpr("*", *extra.split(",")) if extra else df

    return make
