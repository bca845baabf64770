import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))  # compare.py

#: Extra columns whose names clash with those that operators add or use.
CLASHING = ["score", "kept", "shard", "slot", "spans", "hash", "first", "n_tokens", "text2"]


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents table from (doc_id, text) pairs, with columns of clashing names."""

    def make(pairs):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        fields += [T.StructField(c, T.StringType()) for c in CLASHING]
        rows = [(i, t, *[None if k % 2 else c for k, c in enumerate(CLASHING)]) for i, t in pairs]
        return spark.createDataFrame(rows, T.StructType(fields))

    return make


#: Nulls, empty and odd texts, repeated rows, and equal ids.
ODD = [
    (None, None), (None, "a b c"), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "word"),
    (5, "a b c d e f g"), (5, "a b c d e f g"), (5, "a b c d e f h"), (6, "\x1c\x85\xa0\u3000x"),
    (7, "日本語 текст ÀÉ 🎉🎉"), (8, "!!! ... ???"), (9, "x" * 5000), (10, "y " * 3000),
    (11, "<|endoftext|> a<|endoftext|>"),
]
