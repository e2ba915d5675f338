import pytest

WORDS = "the of and to anble onre thion erst ingly ance".split()


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text, lang, source, n_chars) rows from (doc_id, text[, source]) tuples."""

    def build(*rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] else None)
            for r in rows
        ]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long"
        )

    return build


@pytest.fixture(scope="session")
def odd_columns():
    """Adds columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = "kept n_words ids _row _text text_ rank shard slot node size _hash starts decoded row".split()

    def add(df):
        return df.withColumns({n: F.lit("x") for n in names})

    return add
