"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import TEXT, annotate, column, remote

#: Characters that count as symbols, and ASCII white space (fixed values of the contract).
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
#: Rows that costs and rejections are estimated on.
SAMPLE_ROWS = 1000

LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class Page:
    """One text with its words and the base counts, each taken once."""

    def __init__(self, text: str | None):
        self.text = text = text or ""
        # str.split() would part at other white space too
        self.words = words = text.encode().split()
        self.n_words = len(words)
        self.word_chars = len(text) - sum(map(text.count, SPACE))
        self.n_symbols = sum(map(text.count, SYMBOLS))
        self.lines = [x for x in text.split("\n") if x.strip(SPACE)]
        self.n_dup_lines = len(self.lines) - len(set(self.lines))
        self.dup_chars = sum(map(len, self.lines)) - sum(map(len, set(self.lines)))
        self.n_repeat_words = repeats(words)

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def repeats(words: list[bytes]) -> int:
    """Words inside 3-word windows that stand twice or more in the list."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    hit = np.fromiter((often[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


# Each rule is true for a text that it rejects; all have a word or more to look at.


def word_length(page: Page) -> bool:
    """The mean word is shorter than 2 or longer than 12 code points."""
    return not 2 * page.n_words <= page.word_chars <= 12 * page.n_words


def symbols(page: Page) -> bool:
    """More than one symbol in ten words."""
    return 10 * page.n_symbols > page.n_words


def duplicate_lines(page: Page) -> bool:
    """More than three characters in ten stand in lines that repeat an earlier one."""
    return 10 * page.dup_chars > 3 * len(page.text)


def capitals(page: Page) -> bool:
    """More than three words in ten have letters of A-Z, none of a-z, and two bytes or more."""
    shout = sum(len(w) > 1 and w.isupper() for w in page.words)
    return 10 * shout > 3 * page.n_words


def exclamation(page: Page) -> bool:
    """More than one exclamation or question mark in five words."""
    return 5 * (page.text.count("!") + page.text.count("?")) > page.n_words


def letters(page: Page) -> bool:
    """Fewer than seven words in ten have an ASCII letter or a character beyond ASCII."""
    found = sum(LETTER.search(w) is not None for w in page.words)
    return 10 * found < 7 * page.n_words


def common_word(page: Page) -> bool:
    """One word makes up more than three words in ten."""
    return 10 * max(Counter(page.words).values()) > 3 * page.n_words


def variety(page: Page) -> bool:
    """In some thousand of the words, counted from the start, under one in twenty is distinct."""
    return any(
        20 * len(set(part)) < len(part)
        for part in (page.words[i : i + 1000] for i in range(0, page.n_words, 1000))
    )


RULES = {
    f.__name__: f
    for f in (
        word_length, symbols, duplicate_lines, capitals, exclamation, letters, common_word, variety
    )
}


def _trial(batches):
    """Seconds, texts and rejections of each rule on each batch of a sample."""
    for batch in batches:
        pages = [Page(t) for t in batch.column(TEXT).to_pylist()]
        pages = [p for p in pages if p.n_words]
        names, spent, hits = list(RULES), [], []
        for rule in RULES.values():
            began = time.perf_counter()
            hits.append(sum(map(rule, pages)))
            spent.append(time.perf_counter() - began)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(spent), pa.array(hits, pa.int64())],
            ["rule", "seconds", "rejected"],
        )


def cascade(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names, the most rejections per second first.

    The sample is the `sample_rows` distinct texts of the smallest hashes; they are chosen by
    their hashes alone, so that no task gathers texts. Rules that reject nothing there
    go last, the cheapest first; with nothing to measure the order is that of RULES.
    """
    hashed = df.select(column(text).cast("string").alias(TEXT)).select(
        F.xxhash64(TEXT).alias("hash"), TEXT
    )
    chosen = hashed.select("hash").distinct().orderBy("hash").limit(sample_rows)
    # 8 bytes a sampled text
    sample = hashed.join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).select(TEXT)
    trial = sample.mapInArrow(remote(_trial), "rule string, seconds double, rejected long")
    rows = trial.groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("n"))
    found = {r["rule"]: (r["n"], max(r["s"], 1e-9)) for r in rows.collect()}
    worth = {k: (-found[k][0] / found[k][1], found[k][1]) if k in found else (0, 0) for k in RULES}
    return sorted(RULES, key=worth.__getitem__)


def judged(texts, order):
    rules = [RULES[name] for name in order]
    rows = []
    for text in texts:
        page = Page(text)
        failed = page.base_failed
        # any() stops at the first rule that rejects
        kept = not failed and not any(rule(page) for rule in rules)
        rows.append((
            page.n_words, page.word_chars, page.n_symbols, page.n_dup_lines,
            page.n_repeat_words, failed, kept,
        ))
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
    return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]


def quality(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    order: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    r"""Judge every whole text by the base rules and then by the cascade of RULES.

    Words are `[^\x20\x09-\x0D]+`. Adds n_words, word_chars (code points in words), n_symbols,
    n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in 3-word
    windows found twice or more), base_failed (under 50 words, or more than half of them
    repeat) and kept. A text that passes the base is kept if no rule rejects it; the order,
    estimated on a bounded sample, changes only the time this takes.

    A null or empty text has no words and fails the base. Repeated rows and ties are judged
    each alone; an empty table stays empty. Input columns named like a new one give way to it.
    """
    order = cascade(df, text, sample_rows) if order is None else order
    if sorted(order) != sorted(RULES):
        raise ValueError(f"the order must name each of {sorted(RULES)}")
    fields = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean"
    )
    return annotate(df, text, keep, fields, judged, order)
