"""Spelling variants: words one edit apart, found by scanning sorted words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXT, Tables, column, pieces, remote

#: Letters of words: ASCII and the upper half of Latin-1 (fixed values of the contract).
LETTERS = "A-Za-zÀ-ÿ"
#: Words that a task counts before it sends the counts on.
COUNTED = 1 << 18
#: Parts that a word is cut into; one edit leaves all but one of them as they are.
PARTS = 3
#: Words that share all but one part and are compared at once; beyond that the part is halved.
GROUP = 50_000


def _lowered(word: str) -> str:
    """A-Z in lower case; other letters stay."""
    return word.lower() if word.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), word)


def _counts(batches, least, damage):
    """(word, n) for the words of the texts, summed within a task as far as memory allows."""
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    total: Counter = Counter()

    def flushed():
        made = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
        total.clear()
        return pa.RecordBatch.from_arrays(made, ["word", "n"])

    for batch in batches:
        for piece in pieces(batch, TEXT):
            ids = piece.column("id").to_pylist()
            for id, text in zip(ids, piece.column(TEXT).to_pylist(), strict=True):
                found: Counter = Counter()
                for run, n in Counter(runs.findall(text or "")).items():
                    found[_lowered(run)] += n
                if damage:
                    start = zlib.crc32(f"{'' if id is None else id}:".encode())
                    for word in [w for w in found if zlib.crc32(w.encode(), start) % damage == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        n = found.pop(word)
                        if len(word) > least:
                            # added to the total, as it may now equal another word of the text
                            total[word[:at] + word[at + 1 :]] += n
                total.update(found)
                if len(total) >= COUNTED:
                    yield flushed()
    if total:
        yield flushed()


def word_counts(
    df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 7, damage: int = 0
) -> DataFrame:
    """(word, n) of the runs of LETTERS with `least` letters or more, A-Z in lower case.

    Counts of a word are summed within a task, not over tasks. With `damage`, one letter of a run
    is left out if that number divides the CRC-32 of `<id>:<run>` (a null id counts as empty); the
    same rows are thus always damaged alike. A null or empty text has no words; repeated rows count
    as often as they stand there; an empty table gives no rows. Other columns play no part.
    """
    source = df.select(column(id).cast("string").alias("id"), column(text).cast("string").alias(TEXT))
    return source.mapInArrow(remote(_counts, least, damage), "word string, n long")


def borders(length: int) -> list[int]:
    """Where the parts of a word of this length begin, and its end."""
    return [i * length // PARTS for i in range(PARTS + 1)]


def _keyed(batches):
    """A row for each part of a word that may hold the edit, once as the shorter or equally long
    word of a pair and once as the longer one.

    `key` is the shorter length, the part and the rest of the word; `lo` and `hi` are the part's
    borders in the shorter word.
    """
    for batch in batches:
        for small in (batch.slice(k, 20_000) for k in range(0, batch.num_rows, 20_000)):
            keys, words, ns, lows, highs = [], [], [], [], []
            rows = zip(small.column("word").to_pylist(), small.column("n").to_pylist(), strict=True)
            for word, n in rows:
                for more in (0, 1):
                    size = len(word) - more
                    cut = borders(size) if size else []
                    for lo, hi in zip(cut, cut[1:], strict=False):
                        keys.append(f"{size} {lo} {word[:lo]} {word[hi + more:]}")
                        words.append(word)
                        ns.append(n)
                        lows.append(lo)
                        highs.append(hi)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()), pa.array(words, pa.string()),
                    pa.array(ns, pa.int64()), pa.array(lows, pa.int32()),
                    pa.array(highs, pa.int32()),
                ],
                ["key", "word", "n", "lo", "hi"],
            )


def _halved(batches):
    """Rows with either half of their part as the part."""
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in ("key", "word", "n", "lo", "hi")]
        made = []
        for key, word, n, lo, hi in zip(*rows, strict=True):
            size = int(key.split(" ", 1)[0])
            middle, more = (lo + hi) // 2, len(word) - size
            for a, b in ((lo, middle), (middle, hi)):
                made.append((f"{size} {a} {word[:a]} {word[b + more:]}", word, n, a, b))
        columns = list(zip(*made, strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["key", "word", "n", "lo", "hi"],
        )


def scan(query: str, words: list[str], shared: list[int], skips: list[list[int]]):
    """Numbers of the words at an edit distance of exactly one from the query, which is as long as
    they are or one letter shorter.

    The words are sorted. Three entries of the edit matrix make a row: those of a prefix of the word
    against the query's prefixes that are one letter shorter, as long, and one letter longer.
    `shared[k]` letters of word k are those of the word before it, whose rows stand. Where all
    entries of a row are above one, the words that share the prefix are skipped:
    `skips[k][d]` is the first word after k that shares d letters or fewer with word k.
    """
    size, far = len(query), 2
    # entries beyond the query are too far away; a letter on either side keeps places in range
    padded = f"\0{query}\0\0\0"
    rows = [(far, 0, 1 if size else far)]
    k, stand = 0, 0
    while k < len(words):
        word = words[k]
        del rows[stand + 1 :]
        a, b, c = rows[-1]
        skip = 0
        for d in range(stand, len(word)):
            letter = word[d]
            # of prefixes of d + 1 letters against those of d, d + 1 and d + 2 of the query
            x = min(b + 1, a + (padded[d] != letter)) if d <= size else far
            y = min(b + (padded[d + 1] != letter), x + 1, c + 1) if d + 1 <= size else far
            z = min(c + (padded[d + 2] != letter), y + 1) if d + 2 <= size else far
            a, b, c = x, y, z
            rows.append((a, b, c))
            if a > 1 and b > 1 and c > 1:
                skip = d + 1
                break
        if not skip:
            if (b if len(word) == size else a) == 1:
                yield k
            k, stand = k + 1, shared[k + 1] if k + 1 < len(words) else 0
        else:
            k = skips[k][skip - 1]
            stand = min(shared[k], len(rows) - 1) if k < len(words) else 0


def neighbours(group: list[tuple[str, int]], size: int, lo: int, hi: int):
    """(word, number of near words, largest n of them, the first of these) of a group of words
    that differ only in the part from `lo` to `hi` of the shorter word of a pair."""
    group = sorted(group, key=lambda g: g[0][lo : hi + len(g[0]) - size])
    middles = [word[lo : hi + len(word) - size] for word, _ in group]
    shared = [0] + [len(commonprefix(p)) for p in zip(middles, middles[1:], strict=False)]
    # first later word that shares d letters or fewer, for every d below the length
    count = len(middles)
    skips: list[list[int]] = [[]] * count
    following = [count] * (max(map(len, middles)) + 1)
    for k in range(count - 1, -1, -1):
        if k + 1 < count:
            for d in range(shared[k + 1], len(following)):
                following[d] = k + 1
        skips[k] = following[: len(middles[k])]
    near: dict[str, list] = {}

    def add(word, other, n):
        known = near.get(word)
        if known is None:
            near[word] = [1, n, other]
        else:
            known[0] += 1
            if n > known[1] or n == known[1] and other < known[2]:
                known[1:] = n, other

    for at, (word, n) in enumerate(group):
        if len(word) != size:
            continue
        query = middles[at]
        for k in scan(query, middles, shared, skips):
            other, m = group[k]
            # an edit right after the part belongs to the next one, where the pair is met again
            if hi < size and middles[k].startswith(query):
                continue
            add(word, other, m)
            if len(other) != size:
                add(other, word, n)
    return [(word, *v) for word, v in near.items()]


def _near(batches):
    """Near words of each group; the rows come sorted by key."""
    waiting, group, place = None, [], None

    def of_group():
        return neighbours(group, *place) if len(group) > 1 else []

    for batch in batches:
        made = []
        columns = (batch.column(c).to_pylist() for c in ("key", "word", "n", "lo", "hi"))
        for key, word, n, lo, hi in zip(*columns, strict=True):
            if key != waiting:
                made += of_group()
                waiting, group = key, []
                place = (int(key.split(" ", 1)[0]), lo, hi)
            group.append((word, n))
        yield _near_rows(made)
    yield _near_rows(of_group())


def _near_rows(made):
    columns = list(zip(*made, strict=True)) or [[]] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["word", "n_near", "n", "form"],
    )


def near_words(words: DataFrame, tables: Tables, most: int = GROUP) -> DataFrame:
    """(word, n_near, form_n, form) of the words that have near ones.

    `words` holds every word once. Words that agree in all parts but one meet in a group, sorted;
    groups of more than `most` words are dealt out again with the part halved, until it is one
    letter, of which no group holds more than the letters of a script in twos.
    """
    kind = "key string, word string, n long, lo int, hi int"
    rows, found, step = words.select("word", "n").mapInArrow(remote(_keyed), kind), [], 0
    while True:
        step += 1
        rows = tables.write(f"keyed{step}", rows)
        many = (
            rows.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > most).select("key")
        )
        many = tables.write(f"many{step}", many)
        last = many.isEmpty()
        alone = rows if last else rows.join(many, "key", "left_anti")
        found.append(
            alone.repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(remote(_near), "word string, n_near long, n long, form string")
        )
        if last:
            break
        rows = rows.join(many, "key", "left_semi").mapInArrow(remote(_halved), kind)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.min(F.struct((-F.col("n")).alias("n"), "form"))
    summed = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select(
        "word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form")
    )


def roots(links: DataFrame, tables: Tables) -> DataFrame:
    """(word, root): where following (word, form) links ends.

    Each round doubles the number of links followed. A form has several times the occurrences of
    its word, so a chain has at most as many links as counts have digits.
    """
    at = tables.write("links0", links.select("word", F.col("form").alias("root")))
    step = 0
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = at.join(onward, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"),
            F.col("__next").isNotNull().alias("moved"),
        )
        step += 1
        written = tables.write(f"links{step}", joined)
        at = written.drop("moved")
        tables.drop(f"links{step - 1}")
        if written.where("moved").isEmpty():
            return at


def variants(counts: DataFrame, least: int = 2, ratio: int = 10, most: int = GROUP) -> DataFrame:
    """Group words with the spellings they are likely to be errors of.

    `counts` holds words and counts `n`, which are summed by word; words of `least` occurrences
    and more are compared. Two words are near if they differ by one inserted, deleted or replaced
    letter. Gives word, form (its near word of largest n, ties the first in code-point order, if
    that n is `ratio` times the word's or more; else null), root (where forms lead from the word,
    itself if it has none), n, n_near (near words) and form_n (n of the form, else null).

    Null and empty words and null counts are left out; an empty table gives no rows; rows that
    repeat a word add up. Other columns play no part.
    """
    if ratio < 2:
        raise ValueError("a form needs at least twice the occurrences, so that chains end")
    tables = Tables(counts.sparkSession, "spelling")
    summed = (
        counts.where("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    words = tables.write("words", summed)
    near = near_words(words, tables, most)
    known = tables.write(
        "known",
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            *[F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")],
        ),
    )
    tables.drop(*[n for n in tables.paths if n != "known"])
    ends = roots(known.where("form IS NOT NULL"), tables)
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
