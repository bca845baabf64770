"""BPE and token counts against the libraries whose files they read."""

import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstar.llm import bpe, counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tables():
    with open(RANKS, "rb") as ranks, open(JSON, "rb") as json:
        return ranks.read(), json.read()


@pytest.fixture(scope="module")
def coder(tables):
    return bpe.Encoder(tables[0], public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(tables):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, tables[0].splitlines())}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def long_words():
    draw = random.Random(5)
    return ["".join(draw.choice("etaoin") for _ in range(n)) for n in (50, 400, 3000)]


@pytest.mark.parametrize("text", [t or "" for _, t in ODD] + long_words())
def test_ids_are_those_of_the_library(coder, library, text):
    ids = coder.encode(text)
    assert array("I", ids).tolist() == library.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_round_trips(coder, library, text):
    ids = coder.encode(text)
    assert array("I", ids).tolist() == library.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def merged_one_by_one(piece, ranks):
    """The definition: merge the pair of the lowest rank, of equal ones the leftmost."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [
            (ranks[parts[i] + parts[i + 1]], i)
            for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks
        ]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_in_the_order_of_the_definition():
    """Also with tables in which a merge makes pairs of lower ranks than its own."""
    draw = random.Random(8)
    for _ in range(300):
        ranks = {bytes([b]): 1000 + b for b in range(256)}
        for _ in range(12):
            ranks[bytes(draw.choice(b"abc") for _ in range(draw.randrange(2, 5)))] = draw.randrange(900)
        if len(set(ranks.values())) == len(ranks):
            piece = bytes(draw.choice(b"abc") for _ in range(draw.randrange(30)))
            assert bpe.merge(piece, ranks) == merged_one_by_one(piece, ranks) if piece else True


def test_memory_of_pre_tokens_is_bounded(coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    own = bpe.Encoder.__new__(bpe.Encoder)
    own.__dict__ |= coder.__dict__ | {"known": {}, "old": {}}
    for n in range(500):
        own.encode(f" w{n} x{n}")
        assert len(own.known) + len(own.old) < 120


def test_documents(spark, docs, library):
    made = bpe.encode(docs(ODD), RANKS, public_tokenizers.PATTERN)
    assert made.columns.count("n_tokens") == 1 and "score" in made.columns
    rows = made.collect()
    assert len(rows) == len(ODD)
    want = {}
    for i, text in ODD:
        ids = library.encode_ordinary(text or "")
        raw = array("I", ids).tobytes()
        want[(i, text)] = (
            len(ids), hashlib.sha256(raw).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(), ids,
        )
    for r in rows:
        got = (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids)
        assert got == want[(r.doc_id, r.text)]
    back = bpe.decode(made, RANKS).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)


def test_empty_table(docs):
    none = docs([])
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert counts.token_counts(none, JSON).count() == 0


@pytest.fixture(scope="module")
def counter(tables):
    return counts.Counter(tables[1])


@pytest.fixture(scope="module")
def other():
    return Tokenizer.from_file(JSON)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6))
def test_counts_are_those_of_the_library(counter, other, texts):
    want = [len(e.ids) for e in other.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want


def test_counts_of_documents(docs, other):
    made = counts.token_counts(docs(ODD), JSON, limit=3)
    rows = made.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        n = len(other.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 3)


def test_overlapping_pairs_merge_from_the_left(counter):
    words = [b"a" * n for n in range(1, 40)] + [b" " * n for n in range(1, 40)]
    other = Tokenizer.from_file(JSON)
    for word, n in zip(words, counter.lengths(words).tolist(), strict=True):
        ids = other.model.tokenize("".join(counts.byte_letters()[b] for b in word))
        assert n == len(ids)


def test_other_kinds_of_vocabulary_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        table = file.read()
    with pytest.raises(ValueError):
        counts.Counter(table)
