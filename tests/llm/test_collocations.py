"""Phrase collocations against counting all phrases in one place."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import types as T

from tillstar.llm import collocations
from tillstar.llm.common import Tables


def expected(pairs, least=30, longest=4, most=2000):
    counts, sizes = {}, Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for part in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", part)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    made = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + k]
            for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= 80 * found[p[i : i + k]]
        }
        rows = []
        for p, a in found.items():
            if p not in inside:
                score, k = min(
                    (2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))
                )
                rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:most], 1):
            made.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(made)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def table(spark, pairs):
    kind = T.StructType([
        T.StructField(n, T.StringType()) for n in ("lang", "text", "rank", "phrase", "chunk", "a")
    ])
    return spark.createDataFrame([(x, y, "r", "p", None, "a") for x, y in pairs], kind)


@pytest.mark.parametrize("kinds, size", [(3, 50), (700, 5000), (1500, 400_000), (40, 200_000)])
def test_tiles_count_every_pair(kinds, size):
    draw = np.random.default_rng(kinds)
    left, right = (np.minimum(draw.geometric(min(0.5, 6 / kinds), size) - 1, kinds - 1) for _ in range(2))
    code, count, which = collocations.counted(left, right, kinds)
    found = dict(zip(code.tolist(), count.tolist(), strict=True))
    assert found == Counter((left * kinds + right).tolist()) and len(found) == len(code)
    assert (code[which] == left * kinds + right).all()


@pytest.mark.parametrize("block", [40, 1000, collocations.BLOCK])
def test_blocks_add_up(spark, block):
    draw = random.Random(block)
    words = ["of", "the", "new", "york", "Times", "café", "ÀB", "a.b", "x y", "\x1c", "日本"]

    def text():
        return "".join(
            draw.choice(words) + draw.choice([" ", " ", " ", "\t ", ", ", "\n", "! ", "\r"])
            for _ in range(draw.randrange(60))
        )

    pairs = [(draw.choice(["en", "de", None, "und"]), text()) for _ in range(120)]
    pairs += [("en", t) for _, t in ODD]
    df = table(spark, pairs)
    for least, longest, most in ((3, 4, 2000), (2, 5, 40), (9, 2, 7)):
        made = collocations.collocations(
            df, longest=longest, least=least, most=most, block=block
        )
        assert got(made) == expected(pairs, least, longest, most)


def test_languages_without_bound(spark):
    pairs = [(f"l{i % 50}", f"one two three {i % 3}") for i in range(400)]
    made = collocations.collocations(table(spark, pairs), least=2, block=8)
    assert got(made) == expected(pairs, 2)


def test_odd_tables(spark):
    none = collocations.collocations(table(spark, []))
    assert got(none) == []
    pairs = [(None, None), ("en", ""), (None, " \t\n"), ("en", None), ("de", ".,;:!?"), ("de", "w")]
    assert got(collocations.collocations(table(spark, pairs), least=1)) == []
    long = [("en", "same " * 1_000_000), ("en", "same " * 1_000_000), ("en", "z" * 5_000_000)]
    assert got(collocations.collocations(table(spark, long), most=None)) == expected(long)
    with pytest.raises(ValueError):
        collocations.collocations(table(spark, []), longest=1)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 2**60 + 12345
    df = spark.createDataFrame(
        [(big, [big + 7, big + 1], [big + 5, big])], "a long, heads array<long>, tails array<long>"
    )
    score = df.select(collocations._cuts(2).alias("cut")).first().cut
    assert (score.score, score.l, score.r) == (2_000_000 * big // (2 * big + 12), big + 7, big + 5)


def test_scratch_tables_go(spark):
    df = table(spark, [("en", "a b c d " * 40)])
    tables = Tables(spark, "trial")
    collocations.candidates(df, tables)
    assert sorted(tables.paths) == ["phrases1", "phrases2", "phrases3", "phrases4", "sizes"]
