import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 977} fill{i}" for i in range(15_000)) + "."

# ids are nullable, texts null, empty, blank, very long, tied and repeated; ``h`` and ``size``
# clash with names that operators use themselves
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank", "en", "b", 9),
    (2, "the quick brown fox jumps over the lazy dog near the river bank", "en", "a", 9),
    (2, "the quick brown fox jumps over the lazy dog near the river bank", "en", "a", 9),
    (3, None, None, None, 0), (4, "", "en", "a", 0), (5, " \t\n", "xx", "", 0), (None, "lost id text of five words", "en", "c", 1),
    (6, LONG, "en", "b", 7), (7, "Une phrase courte.", "fr", "c", 3), (8, "under the MIT License, and CC-BY-NC 4.0 too", "en", None, 4),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("h", T.LongType()), T.StructField("size", T.LongType())])


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame([(*r, 1) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
