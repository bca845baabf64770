"""Benchmark decontamination by an FM-index over each shard of training texts."""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import (
    TEXT, Tables, alnum_words, column, memory, merged, pieces, remote, runs_of,
)

#: The words of alnum_words in a text as it came, before A-Z are put in lower case.
WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")
#: Words of a window, and bytes of benchmark text whose phrases are searched at once.
WINDOW = 10
BLOCK = 8 << 20
#: Bytes of phrases that are broadcast for one pass over the documents, and of texts that a task
#: holds to search them for several blocks.
SENT = 64 << 20
HELD = 32 << 20
#: Every so many places of a shard's text keep their place in the suffix order.
SAMPLED = 8


class Phrases:
    """Distinct windows of benchmark items as places in the items' word ids, and their owners.

    A window is `size` ids from `start`; `owners` are numbers in `names`, those of window k
    end at `ends[k]`. Pickled it holds four bytes a word, and each word's letters once.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        of: dict[tuple[int, ...], tuple[int, set[int]]] = {}
        sequence: list[int] = []
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in alnum_words(text)]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                row = tuple(words[at : at + window])
                of.setdefault(row, (len(sequence) + at, set()))[1].add(number[item])
            sequence += words
        self.sequence = np.array(sequence, np.int32)
        self.start = np.array([start for start, _ in of.values()], np.int64)
        self.size = np.array([len(row) for row in of], np.int64)
        self.owners = np.array([k for _, own in of.values() for k in sorted(own)], np.int32)
        self.ends = np.cumsum([len(own) for _, own in of.values()], dtype=np.int64)

    def __getstate__(self):
        return {**self.__dict__, "ids": b" ".join(self.ids)}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ids = {word: k for k, word in enumerate(state["ids"].split(), 1)}

    @property
    def shortest(self) -> int:
        return int(self.size.min(initial=self.window))

    def words(self) -> np.ndarray:
        """Windows as rows of word ids, zeros after their end."""
        places = self.start[:, None] + np.arange(self.window)
        inside = np.arange(self.window) < self.size[:, None]
        return np.where(inside, self.sequence[np.where(inside, places, 0)], 0)

    def items(self, windows: np.ndarray) -> set[str]:
        """Items that own any of the windows."""
        begins = np.concatenate(([0], self.ends))
        own = [self.owners[begins[w] : begins[w + 1]] for w in windows.tolist()]
        return {self.names[k] for k in np.unique(np.concatenate(own)).tolist()} if own else set()


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector of counts for each bit, highest first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate((values[~ones], values[ones]))

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        start, at = np.zeros_like(at), at.copy()
        for bit, before, zeros in self.levels:
            one = (symbols >> bit & 1).astype(bool)
            low, high = before[start], before[at]
            start = np.where(one, zeros + low, start - low)
            at = np.where(one, zeros + high, at - high)
        return at - start


def suffix_order(text: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes, by doubling; a suffix ends at its separator, and
    separators differ from each other by their place."""
    rank = text.astype(np.int64) + len(text)
    rank[separators] = np.arange(len(separators))
    width = 1
    while True:
        ahead = np.zeros(len(text), np.int64)
        ahead[:-width] = rank[width:]
        order = np.lexsort((ahead, rank))
        first, second = rank[order], ahead[order]
        new = np.concatenate(([0], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new)
        width *= 2
        if rank[order[-1]] == len(text) - 1 or width >= len(text):
            return order


class FmIndex:
    """Backward search and location over a text whose separators are zeros."""

    def __init__(self, text: np.ndarray, symbols: int):
        separators = np.flatnonzero(text == 0)
        order = suffix_order(text, separators)
        before = text[order - 1]  # the text ends with a separator, so place 0 has one before it
        self.matrix = WaveletMatrix(before, max(1, int(symbols).bit_length()))
        self.before = before
        self.first = np.zeros(symbols + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols + 1), out=self.first[1:])
        # a walk to the left never crosses a separator: the place after one is kept as well
        self.place = np.where((order % SAMPLED == 0) | (before == 0), order, -1)

    def search(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of suffixes that begin with each phrase, as half-open ranges."""
        low, high = np.zeros(len(size), np.int64), np.full(len(size), len(self.place))
        for at in range(words.shape[1] - 1, -1, -1):
            going = np.flatnonzero((size > at) & (low < high))
            symbol = words[going, at]
            low[going] = self.first[symbol] + self.matrix.rank(symbol, low[going])
            high[going] = self.first[symbol] + self.matrix.rank(symbol, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes, by walking left to a place that is kept."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        going = np.flatnonzero(self.place[rows] < 0)
        while len(going):
            at = rows[going]
            symbol = self.before[at]
            rows[going] = self.first[symbol] + self.matrix.rank(symbol, at)
            steps[going] += 1
            going = going[self.place[rows[going]] < 0]
        return self.place[rows] + steps


def occurrences(
    texts: list[list[bytes]], phrases: Phrases
) -> dict[int, tuple[np.ndarray, np.ndarray, list[str]]]:
    """By text: removal spans in words, and the items found.

    The shard's text is every run of benchmark words that is as long as the shortest phrase;
    no occurrence can lie elsewhere, since it holds no other word.
    """
    if not len(phrases.size):
        return {}
    get, parts, owner, origin = phrases.ids.get, [], [], []
    for number, words in enumerate(texts):
        known = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        for start, end in zip(*runs_of(known > 0, phrases.shortest), strict=True):
            parts += [known[start:end], [0]]
            owner.append(number)
            origin.append(int(start))
    if not parts:
        return {}
    text = np.concatenate(parts).astype(np.int64)
    begins = np.concatenate(([0], np.flatnonzero(text == 0)[:-1] + 1))
    index = FmIndex(text, len(phrases.ids))
    low, high = index.search(phrases.words(), phrases.size)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    places = index.locate(np.repeat(low, count) + offset)
    run = np.searchsorted(begins, places, side="right") - 1
    text_of = np.array(owner)[run]
    starts = np.array(origin)[run] + places - begins[run]
    out = {}
    order = np.argsort(text_of, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(text_of[order])) + 1) if len(order) else []:
        spans = merged(starts[group], starts[group] + phrases.size[which[group]])
        out[int(text_of[group[0]])] = (*spans, sorted(phrases.items(np.unique(which[group]))))
    return out


_phrases: dict[str, Phrases] = memory(__name__)


def _packed(batches, window, size):
    """Blocks of items with at most `size` bytes of text each, or one item, as pickled phrases."""
    waiting, total = [], 0

    def block():
        payload = pickle.dumps(Phrases(waiting, window), protocol=5)
        key = hashlib.sha256(payload).hexdigest()
        return pa.RecordBatch.from_pydict({"key": [key], "phrases": [payload]})

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("item", "text")), strict=True)
        for item, text in rows:
            bytes_ = len(text.encode())
            if waiting and total + bytes_ > size:
                yield block()
                waiting, total = [], 0
            waiting.append((item, text))
            total += bytes_
    if waiting:
        yield block()


def blocks(benchmark: DataFrame, item: str, text: str, window: int, size: int) -> DataFrame:
    """(key, phrases): the distinct items of a benchmark, cut into windows by Spark's tasks."""
    rows = benchmark.select(
        column(item).cast("string").alias("item"), column(text).cast("string").alias("text")
    ).where("item IS NOT NULL AND text <> ''").distinct()
    return rows.mapInArrow(remote(_packed, window, size), "key string, phrases binary")


def rounds(packed: DataFrame, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """The blocks in lists of at most `most` bytes, or one block, read one list after the other."""
    waiting, total = [], 0
    for row in packed.toLocalIterator():
        if waiting and total + len(row["phrases"]) > most:
            yield waiting
            waiting, total = [], 0
        waiting.append((row["key"], bytes(row["phrases"])))
        total += len(row["phrases"])
    yield waiting


def _loaded(key: str, payload: bytes) -> Phrases:
    """Phrases of a block; a worker remembers the last one."""
    if key not in _phrases:
        _phrases.clear()
        _phrases[key] = pickle.loads(payload)
    return _phrases[key]


def _shards(batches, most):
    """Lists of pieces with at most `most` bytes of text together, or one piece."""
    waiting, total = [], 0
    for batch in batches:
        for piece in pieces(batch, TEXT):
            bytes_ = piece.column(TEXT).nbytes
            if waiting and total + bytes_ > most:
                yield waiting
                waiting, total = [], 0
            waiting.append(piece)
            total += bytes_
    if waiting:
        yield waiting


def _searched(batches, shared, clean):
    """n_words, spans and items of each text; adds to those that an earlier round found.

    Every block is searched in the index of each piece; with several blocks more pieces are
    held, so that a block is loaded once for all of them. With `clean` the texts come back
    without the spans.
    """
    packed = shared.value
    for shard in _shards(batches, HELD if len(packed) > 1 else 0):
        texts = [[alnum_words(t) for t in piece.column(TEXT).to_pylist()] for piece in shard]
        found = [_earlier(piece) for piece in shard]
        for key, payload in packed:
            phrases = _loaded(key, payload)
            for words, known in zip(texts, found, strict=True):
                for number, (starts, ends, items) in occurrences(words, phrases).items():
                    if number in known:
                        old = known[number]
                        starts, ends = merged(
                            np.concatenate((old[0], starts)), np.concatenate((old[1], ends))
                        )
                        items = sorted({*old[2], *items})
                    known[number] = starts, ends, items
        for piece, words, known in zip(shard, texts, found, strict=True):
            yield _annotated(piece, words, known, clean)


def _earlier(piece):
    """By row: spans and items that an earlier round found."""
    if "__llm_spans" not in piece.schema.names:
        return {}
    rows = zip(*(piece.column(c).to_pylist() for c in ("__llm_spans", "__llm_items")), strict=True)
    return {
        number: (np.array([s["start"] for s in spans]), np.array([s["end"] for s in spans]), items)
        for number, (spans, items) in enumerate(rows) if spans
    }


def _annotated(piece, words, known, clean):
    nothing = (np.zeros(0, int), np.zeros(0, int), [])
    spans, items = [], []
    for number in range(len(words)):
        starts, ends, own = known.get(number, nothing)
        spans.append([{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)])
        items.append(own)
    names = [n for n in piece.schema.names if not n.startswith("__llm_")]
    texts = piece.column(TEXT)
    if clean:
        texts = pa.array(cut(texts.to_pylist(), spans), pa.string())
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [piece.column(n) for n in names] + [
            texts, pa.array([len(w) for w in words], pa.int64()),
            pa.array(spans, pairs), pa.array(items, pa.list_(pa.string())),
        ],
        [*names, TEXT, "__llm_words", "__llm_spans", "__llm_items"],
    )


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
    sent: int = SENT,
    clean: bool = False,
) -> DataFrame:
    r"""Find all windows of benchmark items in every whole text.

    Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` with A-Z in lower case. A window is `window`
    consecutive words of an item; an item of fewer words, but not none, is one window. Adds
    n_words, n_hit (words inside an occurrence), n_items and items (ids as strings, sorted),
    items_sha256 (hex of them, joined by commas), contaminated (n_hit > 0), and spans: the
    merged word ranges [start, end) to remove.

    A null or empty text has no words and no hits; an item without words or with a null id
    takes no part; items that repeat an id are one item. Repeated rows are searched each
    alone; with an empty table on either side nothing is hit. Tasks cut the benchmark into blocks
    of `block` bytes of text; those of at most `sent` bytes together are broadcast and searched one
    after the other in one pass over the documents. A larger benchmark takes several passes, each
    written to the shared folder before the next list of blocks is sent. Input columns named like a
    new one give way to it. With `clean` a kept text comes back without its
    spans, as `remove_spans` makes it.
    """
    new = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "spans"]
    wanted = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    carried = [c for c in wanted if c != text]
    found = df.select(*[column(c) for c in carried], column(text).cast("string").alias(TEXT))
    base = found.schema
    span = "array<struct<start: long, end: long>>"
    added = T.StructType.fromDDL(
        f"__llm_words long, __llm_spans {span}, __llm_items array<string>"
    )
    schema = T.StructType([*base, *added])
    spark, waiting = df.sparkSession, None
    tables = Tables(spark, "decontaminate")
    packed = blocks(benchmark, item, item_text, window, block)
    for number, some in enumerate(rounds(packed, sent)):
        if waiting is not None:
            searched = found.mapInArrow(remote(_searched, waiting, False), schema)
            found = tables.write(f"round{number}", searched)
            waiting.unpersist()
            if number > 1:
                tables.drop(f"round{number - 1}")
        waiting = spark.sparkContext.broadcast(some)
    found = found.mapInArrow(remote(_searched, waiting, clean), schema)
    items = F.col("__llm_items")
    hits = F.aggregate("__llm_spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return found.select(
        *[F.col(TEXT).alias(c) if c == text else column(c) for c in wanted],
        F.col("__llm_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("__llm_spans") > 0).alias("contaminated"),
        F.col("__llm_spans").alias("spans"),
    )


def cut(texts, spans):
    """Texts without their spans of words; a gap of one space is left where words meet."""
    out = []
    for text, ranges in zip(texts, spans, strict=True):
        if text and ranges:
            at = [(m.start(), m.end()) for m in WORD.finditer(text)]
            parts, last = [], 0
            for span in ranges:
                parts.append(text[last : at[span["start"]][0]])
                last = at[span["end"] - 1][1]
            text = "".join([*parts, text[last:]])
        out.append(text)
    return out


def _cut(batches, text):
    for batch in batches:
        names = batch.schema.names
        at = names.index(text)
        made = cut(batch.column(at).to_pylist(), batch.column("spans").to_pylist())
        kept = [n for n in names if n != "spans"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(made, pa.string()) if n == text else batch.column(n) for n in kept], kept
        )


def remove_spans(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The table with the word ranges of `spans` cut out of its texts, without `spans`.

    A null text stays null; rows without spans keep their text as it is. A text that is
    removed whole becomes empty, its row stays.
    """
    named = df.withColumnRenamed(spans, "spans")
    schema = T.StructType([f for f in named.schema if f.name != "spans"])
    return named.mapInArrow(remote(_cut, text), schema)
