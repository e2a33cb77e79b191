import pathlib
import sys

import pytest

sys.path[:0] = [str(pathlib.Path(__file__).parent), str(pathlib.Path(__file__).parents[1])]


@pytest.fixture(scope="session")
def rows(spark):
    """A frame from (doc_id, text, …) rows, with columns whose names clash with those of the operators."""
    def make(data, schema="doc_id long, text string"):
        from pyspark.sql import functions as F
        return spark.createDataFrame(data, schema).withColumns(
            {c: F.lit("mine") for c in ("_words", "_key", "_place", "ids", "shard", "kept", "sketch", "repeats",
                                        "formatted", "n", "doc", "part", "label")})
    return make
