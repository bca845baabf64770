"""Spelling variants against comparing all words with each other."""

import random
import re
import time
import zlib
from collections import Counter

import pytest
from conftest import ODD
from pyspark.sql import types as T

import __spark_entry__ as entry
from tillstar.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def expected(counts, least=2, ratio=10):
    """Rows by word, near words found through all deletions of a letter."""
    words = {w: n for w, n in counts.items() if n >= least}
    holes: dict = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in words}
    for shape, own in holes.items():
        for w in own:
            near[w] |= own if isinstance(shape, tuple) else ({shape} & set(words))
        if isinstance(shape, str) and shape in words:
            near[shape] |= own
    rows = {}
    for w, n in words.items():
        near[w] = {v for v in near[w] if one_edit(w, v)}
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        rows[w] = [form, w, n, len(near[w]), words[form] if form else None]
    for w in rows:
        end = w
        while ratio > 1 and rows[end][0] is not None:
            end = rows[end][0]
        rows[w][1] = end
    return {w: tuple(r) for w, r in rows.items()}


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def damaged_counts(pairs, least=7, damage=31):
    counts = Counter()
    for id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def test_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    made = entry.queries()["op11_spelling"](spark, sf_dir)
    assert made.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = got(made)
    assert found == expected(damaged_counts(rows))
    assert sum(r[0] is not None for r in found.values()) > 5


@pytest.mark.parametrize("seed", range(30))
def test_groups_find_every_pair(seed):
    draw = random.Random(seed)
    letters = draw.choice(["ab", "abc", "abcdefgh"])
    made = ("".join(draw.choice(letters) for _ in range(draw.randrange(1, 10))) for _ in range(90))
    counts = {w: draw.randrange(1, 6) for w in made}
    groups: dict = {}
    for w in counts:
        for more in (0, 1):
            cut = spelling.borders(len(w) - more) if len(w) > more else []
            for lo, hi in zip(cut, cut[1:], strict=False):
                key = (len(w) - more, lo, hi, w[:lo], w[hi + more :])
                groups.setdefault(key, []).append((w, counts[w]))
    near: dict = {}
    for (size, lo, hi, _, _), group in groups.items():
        for w, count, n, form in spelling.neighbours(group, size, lo, hi):
            near.setdefault(w, []).append((count, -n, form))
    rows = expected(counts, 1, 0)  # every nearest word is a form
    assert {w: sum(x[0] for x in v) for w, v in near.items()} == {w: r[3] for w, r in rows.items() if r[3]}
    assert {w: min(x[1:] for x in v) for w, v in near.items()} == {
        w: (-r[4], r[0]) for w, r in rows.items() if r[3]
    }


def expected_pairs(words):
    return {w: sum(one_edit(w, v) for v in words) for w in words}


def test_large_groups_are_halved(spark):
    draw = random.Random(5)
    words = {"a" * draw.randrange(3, 6) + draw.choice(["", "b", "cd"]) + "x" * 9 for _ in range(40)}
    words |= {"stem" + "".join(draw.choice("abcd") for _ in range(6)) + "end" for _ in range(400)}
    counts = {w: draw.choice([2, 3, 40, 700]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    whole, parts = got(spelling.variants(df)), got(spelling.variants(df, most=3))
    assert whole == parts == expected(counts)
    assert {w: r[3] for w, r in whole.items()} == expected_pairs(words)


def test_long_chains_end_at_their_root(spark):
    counts = {"abcdefgh"[: 7 - i] + "z" * i: 3 * 10**i for i in range(8)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = got(spelling.variants(df))
    assert found == expected(counts)
    assert {r[1] for r in found.values()} == {"z" * 7}


def test_a_crowded_prefix_takes_time_in_proportion():
    words = [f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij" for d in "ab"]
    group = [(f"stem{w}end", 2) for w in words]
    began = time.time()
    found = spelling.neighbours(group, 11, 4, 8)
    assert time.time() - began < 5
    assert {w: n for w, n, _, _ in found} == {f"stem{w}end": 9 + 9 + 9 + 1 for w in words}


def test_odd_tables(spark, docs):
    pairs = ODD + [
        (20, "Résumés RÉSUMÉS résumés"), (21, "abcdefg " * 40), (22, "abcdefgh abcdefgh abcdeFgh"),
        (23, "×÷abcdefg×÷ naïvelyß" * 3),
    ]
    table = docs(pairs)
    for damage in (0, 1, 31):
        made = spelling.variants(spelling.word_counts(table, least=7, damage=damage))
        assert got(made) == expected(damaged_counts(pairs, damage=damage))
    assert spelling.variants(spelling.word_counts(docs([]))).count() == 0
    long = "q" * 5_000_000
    made = spelling.word_counts(docs([(1, long), (1, long), (2, f"{long}r {long}r")]))
    assert got(spelling.variants(made)) == {
        long: (None, long, 2, 1, None), f"{long}r": (None, f"{long}r", 2, 1, None)
    }
    kind = T.StructType([T.StructField(n, t) for n, t in (
        ("word", T.StringType()), ("n", T.LongType()), ("form", T.StringType()), ("root", T.StringType())
    )])
    rows = [(None, 5, "f", "r"), ("", 5, "f", "r"), ("a", None, "f", "r"), ("ab", 1, "f", "r"),
            ("ab", 2, "f", "r"), ("b", 30, "f", "r"), ("c", 30, "f", "r")]
    assert got(spelling.variants(spark.createDataFrame(rows, kind))) == {
        "ab": ("b", "b", 3, 1, 30), "b": (None, "b", 30, 2, None), "c": (None, "c", 30, 1, None),
    }
