"""Near-duplicates and passages against brute force."""

import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from tillstar.llm import near, passages
from tillstar.llm.common import PIECE, space_words


def shingle_set(text, size):
    words = space_words(text)
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(pairs, size, percent):
    """Smallest id reachable from each row, by comparing all pairs."""
    sets = [shingle_set(t, size) for _, t in pairs]
    group = list(range(len(pairs)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a] | sets[b])):
                group[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return [
        (i, len(sets[k]), least.get(top(k)) if sets[k] else i, i == (least.get(top(k)) if sets[k] else i))
        for k, (i, _) in enumerate(pairs)
    ]


def near_group(draw, size, edits, copies):
    """Copies of one text that each differ from it in some words, and from each other more."""
    base = [f"b{draw.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(size)] = f"e{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_components_match_brute_force(docs, words):
    draw = random.Random(words)
    texts = [x for _ in range(6) for x in near_group(draw, 60, 8, 12)]
    texts += near_group(draw, 120, 20, 60)  # the most edited ones are linked with nothing
    texts += [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.randrange(1, 9))) for _ in range(60)]
    texts += ["a b", "a b", "b a", "a", "A  B", "a"] + texts[:5] * 4
    order = list(range(len(texts)))
    draw.shuffle(order)
    pairs = [(i, texts[k]) for i, k in enumerate(order)] + ODD
    rows = near.near_duplicates(docs(pairs), words=words).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    want = sorted(
        ((i, n, c, k) for i, n, c, k in brute(pairs, words, 80)), key=str
    )
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(k == (i == c) for i, _, c, k in got)


def test_one_row_of_each_group_stays(docs):
    text = "one two three four five six seven eight nine ten"
    pairs = [(3, text), (1, text), (1, text), (None, text), (2, text.upper()), (7, "another thing"), (8, None), (9, "")]
    kept = near.without_near_duplicates(docs(pairs))
    assert kept.columns == docs(pairs).columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()))
    assert rows == [(1, text), (7, "another thing"), (8, None), (9, "")]


def test_group_without_ids_keeps_one(docs):
    pairs = [(None, "a b c d e f g h"), (None, "a b c d e f g h "), (None, "A b c d e f g h")]
    assert near.without_near_duplicates(docs(pairs)).count() == 1


def test_empty_tables(docs):
    assert near.near_duplicates(docs([])).count() == 0
    assert near.without_near_duplicates(docs([])).count() == 0
    assert passages.repeated_spans(docs([])).count() == 0
    assert passages.without_repeats(docs([])).count() == 0


def test_every_pair_within_the_distance_shares_a_key():
    draw = np.random.default_rng(3)
    parts = near.chunks(0.8)
    most = near.distance(near.COMPONENTS, 0.2)
    assert len(parts) * (near.ERRORS + 1) > most
    for _ in range(300):
        differ = draw.choice(near.COMPONENTS, most, replace=False)
        assert min(np.isin(part, differ).sum() for part in parts) <= near.ERRORS


def test_components_of_long_chains(spark):
    from tillstar.llm.common import Tables

    nodes = spark.range(200).select(F.col("id").alias("node"), F.col("id").alias("comp"))
    links = spark.range(99).select(
        ((F.col("id") * 37) % 100).alias("a"), (((F.col("id") + 1) * 37) % 100).alias("b")
    )
    found = near.components(Tables(spark, "chain"), nodes, links, "x").collect()
    assert {r.node: r.comp for r in found} == {n: 0 if n < 100 else n for n in range(200)}


def plain_units(text):
    """(start, end, words) of the units with words, found letter by letter."""
    out, start, i = [], 0, 0

    def solid(c):
        return not c.isspace() and not c.isalnum() and c != "_" and not re.match(r"\w", c)

    def after(i):
        while i < len(text) and text[i].isspace():
            i += 1
        return i

    def closed(end):
        nonlocal start
        words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text[start:end]))]
        if words:
            out.append((start, end, words))
        start = end

    def low(part):
        return part.translate({c: c + 32 for c in range(65, 91)})

    while i < len(text):
        if text[i] in "\n\u2028\u2029":
            i = after(i)
            closed(i)
        elif solid(text[i]):
            stop = i
            while stop < len(text) and solid(text[stop]):
                stop += 1
            spaced = after(stop) > stop
            while i < stop:
                if text[i] in ".!?" and spaced:
                    i = after(stop)
                    closed(i)
                elif text[i] in passages.MARKS:
                    i += 1
                    while i < stop and (text[i] in passages.MARKS or text[i] in ".!?"):
                        i += 1
                    while i < stop and text[i] in passages.CLOSING.replace("\\", ""):
                        i += 1
                    if i == stop:
                        i = after(i)
                    closed(i)
                else:
                    i += 1
        else:
            i += 1
    closed(len(text))
    return [(a, b, len(words), b" ".join(words)) for a, b, words in out]


def test_units_are_those_found_letter_by_letter():
    draw = random.Random(4)
    letters = list("ab_ .!?\n\t\"')-,9Z") + list("。！」　।—é\u2028")
    for _ in range(20_000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(16)))
        expected = [x[:3] for x in plain_units(text)]
        assert [u[:3] for u in passages.units(text)] == expected, text


def test_runs_of_marks_take_time_in_proportion(docs):
    runs = [".", "!?", ".x", "。", ".。", "-", " ", "\n", '."', " \n", "\u0964 "]
    for run in runs:
        text = run * (200_000 // len(run))
        began = time.time()
        list(passages.units(text + "x"))
        assert time.time() - began < 3, run
    line = "Contents " + "." * 20_000 + "12"
    text = (line + "\n") * 250  # 5 MB
    cut = {r.doc_id: r.text for r in passages.without_repeats(docs([(1, text), (2, "own")])).collect()}
    assert cut == {1: line + "\n", 2: "own"}


def expected_spans(pairs, least):
    ranked = sorted(
        {(i is None, i or 0, t): (i, t) for i, t in pairs if t}.values(),
        key=lambda p: (p[0] is None, p[0] or 0),
    )
    first, out = {}, {}
    for i, t in ranked:
        for at, (_, _, _, digest) in enumerate(plain_units(t)):
            first.setdefault(digest, (i, t, at))
    for i, t in ranked:
        runs, last = [], None
        for at, (start, end, words, digest) in enumerate(plain_units(t)):
            if first[digest] != (i, t, at):
                if last == at - 1 and runs:
                    runs[-1][1], runs[-1][2] = end, runs[-1][2] + words
                else:
                    runs.append([start, end, words, first[digest][0]])
                last = at
        found = [tuple(r) for r in runs if r[2] >= least]
        if found:
            out[(i, t)] = found
    return out


def test_passages_match_brute_force(docs):
    draw = random.Random(9)
    sentence = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.randrange(1, 14))) + draw.choice(".!?") for _ in range(60)]
    pairs = []
    for i in range(80):
        text = ""
        for _ in range(draw.randrange(12)):
            text += draw.choice(sentence) + draw.choice([" ", "\n", "  \n\n", "\t"])
        pairs.append((i, text))
    pairs += [(i, t) for i, t in ODD if i != 5 and i is not None] + [pairs[3], (None, pairs[5][1] + " tail")]
    rows = passages.repeated_spans(docs(pairs), least=6).select("id", "hash", "spans")
    by_hash = docs(pairs).select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    text_of = {(r.doc_id, r.h): r.text for r in by_hash}
    got = {
        (r.id, text_of[(r.id, r.hash)]): sorted((s.start, s.end, s.words, s.kept_id) for s in r.spans)
        for r in rows.collect()
    }
    assert got == expected_spans(pairs, 6)


def test_cut_keeps_the_first_and_original_offsets(docs):
    passage = "This passage of many words is shared by all of them. It has a second sentence too."
    pairs = [(2, f"Own start here, {passage} Own end."), (1, f"Another.\n{passage}\nLast line."), (3, passage.upper())]
    cut = {r.doc_id: r.text for r in passages.without_repeats(docs(pairs)).collect()}
    assert cut[1] == pairs[1][1]
    assert cut[3] == ""
    # the first sentence is joined to words before it; the second one is too short alone
    assert cut[2] == pairs[0][1]
    spans = passages.repeated_spans(docs(pairs), least=5).where("id = 2").first().spans
    assert [pairs[0][1][s.start : s.end] for s in spans] == ["It has a second sentence too. "]
    assert spans[0].kept_id == 1


CHINESE = "本網站的全部內容均受著作權法保護，未經書面許可不得轉載或複製。讀者如有任何疑問，請於上班時間聯絡編輯部，我們將盡快回覆您的來信與建議！"


def test_repeated_chinese_passage_goes(docs):
    own = ["今天的天氣很好。", "他說：「我們明天見。」", "這是另外一段文字？"]
    pairs = [(1, own[0] + CHINESE + own[1]), (2, "短句。" + CHINESE), (3, own[2] + CHINESE + "完"), (4, own[0])]
    cut = {r.doc_id: r.text for r in passages.without_repeats(docs(pairs)).collect()}
    assert cut == {1: pairs[0][1], 2: "短句。", 3: own[2] + "完", 4: own[0]}


def test_sentences_end_at_marks_of_other_scripts():
    text = "他說：「明天見。」今天很好！？「是的」嗎｡ हम घर गए। ठीक है॥ كيف حالك؟ نعم۔ end"
    parts = [text[a:b].strip() for a, b, *_ in passages.units(text)]
    assert parts == [
        "他說：「明天見。」", "今天很好！？", "「是的」嗎｡", "हम घर गए।", "ठीक है॥", "كيف حالك؟", "نعم۔", "end",
    ]


def test_letters_of_unspaced_scripts_alone_count(docs):
    thai = "สงวนลิขสิทธิ์ตามกฎหมายห้ามนำเนื้อหาส่วนใดส่วนหนึ่งไปเผยแพร่ต่อโดยไม่ได้รับอนุญาต"
    few = "Unauthorised reproduction redistribution retransmission prohibited worldwide"
    assert passages.unspaced(few) == 0 < 50 <= passages.unspaced(thai)
    pairs = [(k, f"{k}.\n{line}\nEnd {k}.") for k, line in enumerate([few, few, thai, thai])]
    cut = {r.doc_id: r.text for r in passages.without_repeats(docs(pairs)).collect()}
    assert cut == {**dict(pairs[:3]), 3: "3.\nEnd 3."}


def plain_runs(units, least, letters):
    """Runs of units that follow each other, by a plain loop over one text."""
    runs, last = [], None
    for at, start, end, words, signs, kept in sorted(units, key=lambda u: u[0]):
        if runs and at == last + 1:
            runs[-1] = (runs[-1][0], end, runs[-1][2] + words, runs[-1][3], runs[-1][4] + signs)
        else:
            runs.append((start, end, words, kept, signs))
        last = at
    return [r[:4] for r in runs if r[2] >= least or r[4] >= letters]


def batch_of_units(texts):
    """What `_spans` gets: lists of (at, start, end, words, letters, kept_id) by text."""
    names = ["at", "start", "end", "words", "letters"]
    unit = pa.struct([*((n, pa.int32()) for n in names), ("kept_id", pa.string())])
    lists = [[dict(zip([*names, "kept_id"], u, strict=True)) for u in text] for text in texts]
    return pa.RecordBatch.from_arrays(
        [pa.array([f"t{k}" for k in range(len(texts))]), pa.array(range(len(texts)), pa.int64()),
         pa.array(lists, pa.list_(unit))],
        ["id", "hash", "units"],
    )


def test_spans_of_many_units_take_little_memory():
    draw = random.Random(3)
    texts = []
    for _ in range(3000):
        places = [at for at in range(100) if draw.random() < 0.6]
        draw.shuffle(places)
        texts.append([
            (at, 40 * at, 40 * at + 39, draw.randrange(1, 9), draw.randrange(3) * 20, draw.choice([None, "a", f"k{at}"]))
            for at in places
        ])
    texts[7], texts[2999] = [], texts[2999][:1]
    texts[11] = [(at, at, at + 1, 1, 0, "long") for at in range(100_000)]  # more than are done at once
    batch = batch_of_units(texts)
    whole = pa.Table.from_batches([batch])
    expected = [plain_runs(t, 10, 50) for t in texts]
    tracemalloc.start()
    made = list(passages._spans([batch.slice(0, 0), batch], 10, 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20, peak
    got = pa.Table.from_batches(made)
    assert got.column("id").equals(whole.column("id")) and got.column("hash").equals(whole.column("hash"))
    assert [[tuple(s.values()) for s in t] for t in got.column("spans").to_pylist()] == expected
    assert len(expected[11]) == 1 and any(len(t) > 2 for t in expected)
    # a part of a batch gives its own rows
    half = pa.Table.from_batches(passages._spans([batch.slice(1500, 900)], 10, 50))
    assert [[tuple(s.values()) for s in t] for t in half.column("spans").to_pylist()] == expected[1500:2400]


def test_texts_are_cut_by_the_piece():
    texts = ["ab" * (PIECE // 4), None, "", "cd" * (PIECE // 3), "é" * PIECE, "end"]
    spans = [[{"start": 2, "end": PIECE // 4}], None, [], [{"start": 0, "end": 4}], [{"start": 1, "end": PIECE}], None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array(texts), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
        ["doc_id", "text", "__llm_spans"],
    )
    made = list(passages._without([batch], "text"))
    assert [b.num_rows for b in made] == [3, 1, 1, 1]
    whole = pa.Table.from_batches(made)
    assert whole.column_names == ["doc_id", "text"]
    assert whole.column("doc_id").to_pylist() == list(range(6))
    assert whole.column("text").to_pylist() == [
        "ab" + texts[0][PIECE // 4 :], None, "", texts[3][4:], "é", "end",
    ]
