import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or full rows, with columns whose names clash."""

    def build(rows):
        full = [r if len(r) == 4 else (*r, "en", "s") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        from pyspark.sql import functions as F

        extras = ("kept", "score", "n", "u", "_t", "salt", "kind", "rank", "component_id", "_norm", "doc")
        return df.withColumns({c: F.lit("clash") for c in extras})

    return build
