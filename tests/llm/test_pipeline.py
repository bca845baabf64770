"""Each stage of the pipeline on what the one before kept, against brute force."""

import base64

import public_tokenizers
import pytest
import tiktoken
from test_dedup import brute, expected_spans

import corpus_pipeline
from tillstar.llm import decontaminate, toxicity
from tillstar.llm.common import alnum_words


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows before the first stage and after each, and the table that each one read."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf_dir).write.parquet(f"{folder}/{number}")
        tables.append(spark.read.parquet(f"{folder}/{number}"))
    return [{r.doc_id: r for r in t.collect()} for t in tables], tables


def test_toxic_documents_go(spark, sf_dir, stages):
    rows, tables = stages
    model = toxicity.fit(tables[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.toxicity(tables[0], model).collect()
    assert set(rows[1]) == {r.doc_id for r in scored if r.score < 0.5}
    assert 0 < len(rows[1]) < len(rows[0])
    assert all(rows[1][i] == rows[0][i] for i in rows[1])


def test_one_document_of_a_group_stays(stages):
    rows, _ = stages
    pairs = [(i, r.text) for i, r in rows[1].items()]
    assert set(rows[2]) == {i for i, _, _, kept in brute(pairs, 5, 80) if kept}
    assert len(rows[2]) < len(rows[1])
    assert all(rows[2][i] == rows[1][i] for i in rows[2])


def test_repeated_passages_go(stages):
    rows, _ = stages
    spans = expected_spans([(i, r.text) for i, r in rows[2].items()], 10)
    assert spans and set(rows[3]) == set(rows[2])
    for i, r in rows[2].items():
        text = r.text
        for start, end, _, _ in reversed(sorted(spans.get((i, text), []))):
            text = text[:start] + text[end:]
        assert rows[3][i].text == text


def test_benchmark_passages_go(spark, sf_dir, stages):
    rows, _ = stages
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    windows = set()
    for item in items:
        words = alnum_words(item.text)
        width = min(len(words), decontaminate.WINDOW)
        windows |= {tuple(words[k : k + width]) for k in range(len(words) - width + 1) if words}
    sizes = {len(w) for w in windows}

    def hit(text):
        words = alnum_words(text)
        return any(tuple(words[k : k + n]) in windows for n in sizes for k in range(len(words) - n + 1))

    assert set(rows[4]) == set(rows[3])
    touched = {i for i, r in rows[3].items() if hit(r.text)}
    assert touched
    for i, r in rows[3].items():
        assert (rows[4][i].text != r.text) == (i in touched)


def test_ids_are_those_of_the_library(stages):
    rows, _ = stages
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    assert set(rows[5]) == set(rows[4])
    for i, r in rows[4].items():
        assert rows[5][i].ids == library.encode_ordinary(r.text or "")
