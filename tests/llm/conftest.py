import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = ("the quick brown fox jumps over the lazy dog and runs into the deep forest of the north where it is cold and "
         "the wind blows for days on end with no rest for the tired animal that wants to be home with all of its friends ")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text[, source]) rows."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def clash(spark):
    """Adds columns whose names the operators use inside."""
    def add(df):
        from pyspark.sql import functions as F
        for c in ("row", "doc", "th", "ta", "words", "lines", "key", "kept", "fp", "n_words", "component", "gone", "place", "v"):
            df = df.withColumn(c, F.lit(f"own {c}"))
        return df
    return add
