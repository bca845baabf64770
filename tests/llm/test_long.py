"""Very long and adversarial texts: every query takes time in proportion and loses no row."""

import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillstar.llm import queries

SIZE = 500_000
draw = random.Random(1)


def shapes():
    made = [
        ".", "?!", ". ", "a", "word ", "same line here\n", "\n", " ", "日本語。", "🎉", "\x00", "éÀ", "a1!",
        "mit license apache license ", "#*$%&|<>", "the quick brown fox jumps over it. ", "<|endoftext|>",
    ]
    texts = [shape * (SIZE // len(shape.encode())) for shape in made]
    texts.append(" ".join(str(i) for i in range(SIZE // 7)))
    texts.append("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(SIZE)))
    texts.append(" ".join("".join(draw.choices("abcdefghij", k=draw.randrange(1, 12))) for _ in range(SIZE // 7)))
    return texts


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("long"))
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{made}/{name}.parquet")
    for name, key, text in (("documents", "doc_id", "text"), ("pages", "page_id", "html")):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        more = spark.createDataFrame([(10**7 + k, t) for k, t in enumerate(shapes())], "key long, value string")
        columns = {f.name: F.lit(None).cast(f.dataType) for f in table.schema}
        columns |= {key: F.col("key").cast(table.schema[key].dataType), text: F.col("value")}
        rows = more.select(*[c.alias(n) for n, c in columns.items()])
        table.unionByName(rows).repartition(16).write.parquet(f"{made}/{name}.parquet")
    return made


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_long_texts(name, spark, folder):
    began = time.time()
    rows = entry.queries()[name](spark, folder).collect()
    assert time.time() - began < 60
    keys = {"doc_id", "page_id"} & set(rows[0].asDict())
    if name != "op3_passages" and keys:
        of = "pages" if "page_id" in keys else "documents"
        assert len(rows) == spark.read.parquet(f"{folder}/{of}.parquet").count()
