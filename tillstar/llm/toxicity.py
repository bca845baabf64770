"""Toxicity by a bidirectional gated recurrent network with attention, trained in numpy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import TEXT, Tables, alnum_words, annotate, column, remote

#: Words of a window and from one window to the next; widths of word vectors, of the hidden state
#: of each direction and of the attention; hash buckets of words and of letter triples.
WINDOW, STRIDE = 32, 16
WIDE, HIDDEN, ATTEND = 16, 8, 8
BUCKETS = 1 << 13
#: The training sample: labelled texts of each class at most, and windows of all its whole texts.
POSITIVE, NEGATIVE, WINDOWS = 2000, 4000, 240_000
EPOCHS, BATCH, RATE, CALIBRATE = 10, 512, 0.01, 4
#: Words whose vectors are made, and windows that are scored, at once.
AT_ONCE = 4096

Model = dict[str, np.ndarray]


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, the buckets of its letter triples, and where these begin.

    A word has spaces around it, so each has a triple at its start and its end.
    """
    whole = np.array([zlib.crc32(w) % BUCKETS for w in words], np.int64)
    raw = np.frombuffer(b"".join(b" %b " % w for w in words), np.uint8).astype(np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    code = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * 0x9E3779B1 >> 7 & (BUCKETS - 1)
    inside = np.ones(len(raw), bool)
    ends = np.cumsum(sizes + 2)
    inside[ends - 1] = inside[ends - 2] = False
    return whole, code[inside[: len(code)]], np.cumsum(sizes) - sizes


def vectors(model: Model, parts, shown: np.ndarray | float = 1) -> np.ndarray:
    """A word's vector: that of its bucket, where that is shown, and the mean of those of its
    letter triples."""
    whole, triples, begins = parts
    ends = np.append(begins, len(triples))
    letters = np.empty((len(whole), WIDE), np.float32)
    for at in range(0, len(whole), AT_ONCE):
        edge = ends[at : at + AT_ONCE + 1]
        some = model["letters"][triples[edge[0] : edge[-1]]]
        letters[at : at + AT_ONCE] = np.add.reduceat(some, edge[:-1] - edge[0], axis=0)
    letters /= np.diff(ends)[:, None]
    letters += model["words"][whole] * shown
    return letters


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_model(seed: int = 4) -> Model:
    draw = np.random.default_rng(seed)

    def some(*shape, scale=None):
        scale = 1 / np.sqrt(shape[0]) if scale is None else scale
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    model = {
        "words": some(BUCKETS, WIDE, scale=0.01), "letters": some(BUCKETS, WIDE, scale=0.05),
        "attend": some(2 * HIDDEN, ATTEND), "ask": some(ATTEND), "out": some(2 * HIDDEN),
        "bias": np.zeros(1, np.float32),
    }
    for way in "fb":
        model |= {
            f"in_{way}": some(WIDE, 3 * HIDDEN), f"own_{way}": some(HIDDEN, 3 * HIDDEN),
            f"bias_{way}": np.zeros(3 * HIDDEN, np.float32),
        }
    return model


def gates(model: Model, x: np.ndarray, way: str) -> np.ndarray:
    """What each word adds to the gates; the last row, for no word, keeps the state."""
    made = x @ model[f"in_{way}"] + model[f"bias_{way}"]
    none = np.zeros((1, 3 * HIDDEN), np.float32)
    none[:, :HIDDEN] = 50
    return np.concatenate((made, none))


def steps(way: str) -> list[int]:
    return list(range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1))


def recurrent(model: Model, table: np.ndarray, at: np.ndarray, way: str, keep: list | None = None):
    """States (window place, window, HIDDEN) of one direction; `at` holds words by place."""
    own, h = model[f"own_{way}"], np.zeros((at.shape[1], HIDDEN), np.float32)
    states = np.empty((WINDOW, at.shape[1], HIDDEN), np.float32)
    for t in steps(way):
        into, back = table[at[t]], h @ own
        both = sigmoid(into[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        n = np.tanh(into[:, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((t, h, z, r, n, back[:, 2 * HIDDEN :]))
        states[t] = h = new
    return states


def pooled(model: Model, states: np.ndarray, real: np.ndarray):
    """Attention over the places that have words: its hidden layer, weights and the mean state."""
    hidden = np.tanh(states @ model["attend"])
    asked = np.where(real, hidden @ model["ask"], -1e9)
    weight = np.exp(asked - asked.max(0))
    weight /= weight.sum(0)
    return hidden, weight, (states * weight[:, :, None]).sum(0)


def window_scores(model: Model, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Chance of each window (a row of word numbers; len(x) for no word) to be toxic."""
    tables = {way: gates(model, x, way) for way in "fb"}
    out = np.empty(len(at), np.float32)
    for start in range(0, len(at), AT_ONCE):
        part = np.ascontiguousarray(at[start : start + AT_ONCE].T)
        states = np.concatenate([recurrent(model, tables[w], part, w) for w in "fb"], 2)
        mean = pooled(model, states, part < len(x))[2]
        out[start : start + AT_ONCE] = sigmoid(mean @ model["out"] + model["bias"])
    return out


def gradients(
    model: Model, parts, at: np.ndarray, label: np.ndarray, shown: np.ndarray | float = 1
) -> Model:
    """Gradients of the mean cross-entropy of windows."""
    x = vectors(model, parts, shown)
    at = np.ascontiguousarray(at.T)
    kept = {way: [] for way in "fb"}
    states = np.concatenate(
        [recurrent(model, gates(model, x, way), at, way, kept[way]) for way in "fb"], 2
    )
    hidden, weight, mean = pooled(model, states, at < len(x))
    error = (sigmoid(mean @ model["out"] + model["bias"]) - label) / len(label)
    grad = {"out": mean.T @ error, "bias": error.sum(keepdims=True)}
    to_mean = error[:, None] * model["out"]
    to_weight = (states * to_mean).sum(2)
    to_asked = weight * (to_weight - (weight * to_weight).sum(0))
    to_hidden = to_asked[:, :, None] * model["ask"] * (1 - hidden**2)
    grad["ask"] = np.einsum("tbm,tb->m", hidden, to_asked)
    grad["attend"] = np.einsum("tbh,tbm->hm", states, to_hidden)
    to_states = weight[:, :, None] * to_mean + to_hidden @ model["attend"].T
    to_x = np.zeros_like(x)
    order = np.argsort(at.ravel(), kind="stable")
    numbers, begins = np.unique(at.ravel()[order], return_index=True)
    for number, way in enumerate("fb"):
        own = model[f"own_{way}"]
        to_own, carry = np.zeros_like(own), np.zeros_like(to_states[0, :, :HIDDEN])
        to_gates = np.empty((*at.shape, 3 * HIDDEN), np.float32)
        for t, h, z, r, n, back in reversed(kept[way]):
            to_h = to_states[t, :, number * HIDDEN : (number + 1) * HIDDEN] + carry
            to_n = to_h * (1 - z) * (1 - n**2)
            to_z = to_h * (h - n) * z * (1 - z)
            to_r = to_n * back * r * (1 - r)
            to_back = np.concatenate((to_z, to_r, to_n * r), 1)
            to_own += h.T @ to_back
            carry = to_h * z + to_back @ own.T
            to_gates[t] = np.concatenate((to_z, to_r, to_n), 1)
        flat = to_gates.reshape(-1, 3 * HIDDEN)[order]
        table = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        table[numbers] = np.add.reduceat(flat, begins, axis=0)
        table = table[:-1]
        grad |= {f"own_{way}": to_own, f"in_{way}": x.T @ table, f"bias_{way}": table.sum(0)}
        to_x += table @ model[f"in_{way}"].T
    whole, triples, starts = parts
    count = np.diff(np.append(starts, len(triples)))
    for name, rows, values in (
        ("words", whole, to_x * shown),
        ("letters", triples, np.repeat(to_x / count[:, None], count, axis=0)),
    ):
        by_row = np.argsort(rows, kind="stable")
        found, begin = np.unique(rows[by_row], return_index=True)
        grad[name] = np.zeros_like(model[name])
        grad[name][found] = np.add.reduceat(values[by_row], begin, axis=0)
    return grad


def subset(parts, numbers: np.ndarray):
    """Features of some words."""
    whole, triples, begins = parts
    counts = np.diff(np.append(begins, len(triples)))[numbers]
    starts = np.cumsum(counts) - counts
    at = np.repeat(begins[numbers] - starts, counts) + np.arange(counts.sum())
    return whole[numbers], triples[at], starts


def train(texts: list[tuple[int, list[bytes]]], seed: int = 4) -> Model | None:
    """A model from (label, windows) of labelled texts; None unless both labels occur.

    The words of a window are parted by spaces.

    A toxic text has a toxic window somewhere. The first epochs take windows of toxic texts for
    toxic, as many of each text as they can; the others take the window of the highest score, and those above one half. Each
    epoch adds windows of clean texts, some drawn and some of the highest scores. One text in
    CALIBRATE is left out; these texts then move the bias so that a score of one half parts them
    best.
    """
    if {label for label, windows in texts if windows} != {0, 1}:
        return None
    ids: dict[bytes, int] = {}
    rows, owner = [], []
    for number, (_, windows) in enumerate(texts):
        for words in windows:
            found = [ids.setdefault(w, len(ids)) for w in words.split()]
            rows.append(np.array(found, np.int32))
            owner.append(number)
    at = np.full((len(rows), WINDOW), len(ids), np.int32)
    for row, words in zip(at, rows, strict=True):
        row[: len(words)] = words
    owner = np.array(owner)
    label = np.array([label for label, _ in texts])[owner]
    parts, draw = features(list(ids)), np.random.default_rng(seed)
    model = new_model(seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    turn = 0
    aside = (draw.permutation(len(texts)) % CALIBRATE == 0)[owner]
    if len(np.unique(label[~aside])) < 2:
        aside[:] = False
    positive, negative = (np.flatnonzero((label == kind) & ~aside) for kind in (1, 0))
    for epoch in range(EPOCHS):
        chosen, hard = positive, negative[:0]
        if epoch >= 2:
            scores = window_scores(model, vectors(model, parts), at)
            order = positive[np.lexsort((-scores[positive], owner[positive]))]
            top = np.concatenate(([True], owner[order][1:] != owner[order][:-1]))
            chosen = order[top | (scores[order] > 0.5)]
            hard = negative[np.argsort(-scores[negative], kind="stable")[: POSITIVE]]
        count = min(len(chosen), POSITIVE)
        chosen = draw.permutation(chosen)
        if epoch < 2:  # a first window of each text, then a second one, ...
            chosen = chosen[np.argsort(turns(owner[chosen]), kind="stable")]
        chosen = chosen[:count]
        easy = draw.permutation(negative)[: 2 * count]
        mixed = draw.permutation(np.concatenate((chosen, easy, hard)))
        rate = RATE * (1 if epoch < EPOCHS - 3 else 0.3)
        size = min(BATCH, max(16, len(mixed) // 40))
        for start in range(0, len(mixed), size):
            batch = mixed[start : start + size]
            numbers, local = np.unique(at[batch], return_inverse=True)
            local = local.reshape(len(batch), WINDOW)
            numbers = numbers[numbers < len(ids)]  # the last number stands for an empty place
            # half of the words show their letters alone, so that new words can be judged by them
            shown = draw.integers(0, 2, (len(numbers), 1)).astype(np.float32)
            grad = gradients(
                model, subset(parts, numbers), local, label[batch].astype(np.float32), shown
            )
            turn += 1
            for name, g in grad.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                step = first[name] / (1 - 0.9**turn)
                scale = np.sqrt(second[name] / (1 - 0.99**turn)) + 1e-6
                model[name] -= (rate * step / scale).astype(np.float32)
    if aside.any():
        scores = window_scores(model, vectors(model, parts), at[aside])
        numbers, first = np.unique(owner[aside], return_index=True)
        highest = np.maximum.reduceat(scores, first).astype(np.float64).clip(1e-6, 1 - 1e-6)
        model["bias"] -= np.float32(parting(np.log(highest / (1 - highest)), label[aside][first]))
    return model


def turns(owner: np.ndarray) -> np.ndarray:
    """How many before each have the same owner."""
    order = np.argsort(owner, kind="stable")
    _, first, count = np.unique(owner[order], return_index=True, return_counts=True)
    out = np.empty(len(owner), np.int64)
    out[order] = np.arange(len(owner)) - np.repeat(first, count)
    return out


def parting(values: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest gap between values that parts the labels with fewest errors;
    0 unless both labels occur."""
    if len(np.unique(label)) < 2:
        return 0.0
    order = np.argsort(values, kind="stable")
    values, label = values[order], label[order]
    # errors with a cut before each value from the second on
    errors = np.cumsum(label)[:-1] + (label == 0).sum() - np.cumsum(label == 0)[:-1]
    gaps = np.where(errors == errors.min(), np.diff(values), -1)
    best = int(gaps.argmax())
    return float(values[best] + values[best + 1]) / 2


def starts(count: int) -> range:
    """Where the overlapping windows of a text of `count` words begin; the last reaches its end."""
    return range(0, max(1, count - WINDOW + STRIDE), STRIDE) if count else range(0)


#: What a text of the sample is known by, and its label.
KEY = ["id", "hash", "order", "label"]


def _windows(batches, most):
    """Key, number of windows and windows of each text; a text of more than `most` has none."""
    for batch in batches:
        sizes, made = [], []
        for text in batch.column(TEXT).to_pylist():
            words = alnum_words(text)
            begin = starts(len(words))
            sizes.append(len(begin))
            made.append(
                [b" ".join(words[s : s + WINDOW]) for s in begin] if len(begin) <= most else []
            )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in KEY), pa.array(sizes, pa.int64()),
                pa.array(made, pa.list_(pa.binary())),
            ],
            [*KEY, "size", "windows"],
        )


def fitting(texts: list, most: int) -> list:
    """Of texts with a size, taken in turn, those that have `most` windows together; one that would
    go beyond it is left out whole."""
    total, out = 0, []
    for one in texts:
        if total + one.size <= most:
            total += one.size
            out.append(one)
    return out


def fit(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    positive: int = POSITIVE,
    negative: int = NEGATIVE,
    windows: int = WINDOWS,
) -> Model | None:
    """Train on a sample of the labelled texts outside the held-out fifth.

    Of each class the labelled texts of `df` with the smallest hashes of id and text, `positive` and
    `negative` at most, are taken, with all their windows: a third of `windows` for toxic texts and
    the rest for clean ones bounds them, and a text that doesn't fit any more is left out whole. An
    id with both labels counts as toxic; null labels and ids take no part, nor do labels without a
    text. Rows that repeat both id and text are one text.
    """
    known = (
        labels.select(column(id).alias("id"), column(label).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    source = df.select(
        column(id).alias("id"), column(text).cast("string").alias(TEXT),
    ).withColumn("hash", F.xxhash64(TEXT))
    there = (
        source.where(F.col(TEXT).isNotNull()).select("id", "hash").distinct().join(known, "id")
        .withColumn("order", F.xxhash64(F.col("id").cast("string"), "hash"))
    )
    sample = there.where("label = 1").orderBy("order", "id", "hash").limit(positive).unionByName(
        there.where("label = 0").orderBy("order", "id", "hash").limit(negative)
    )
    # at most positive + negative rows
    rows = (
        source.join(F.broadcast(sample), ["id", "hash"])
        .groupBy(*KEY)
        .agg(F.first(TEXT).alias(TEXT))
    )
    bounds = {1: windows // 3, 0: windows - windows // 3}
    kind = rows.select(*KEY).schema
    for name, type in (("size", T.LongType()), ("windows", T.ArrayType(T.BinaryType()))):
        kind = kind.add(name, type)
    tables = Tables(df.sparkSession, "toxicity")
    found = tables.write("sample", rows.mapInArrow(remote(_windows, max(bounds.values())), kind))
    # sizes first, so that windows of texts beyond the bound don't come to the driver
    sizes = sorted(found.select("order", "hash", "label", "size").collect())
    chosen = [
        row for label, most in bounds.items()
        for row in fitting([r for r in sizes if r.label == label], most)
    ]
    if len(chosen) < len(sizes):
        taken = df.sparkSession.createDataFrame(chosen, "order long, hash long, label int, size long")
        found = found.join(F.broadcast(taken.distinct()), ["order", "hash", "label", "size"])
    table = found.select("label", "windows").toArrow()
    texts = list(zip(table["label"].to_pylist(), table["windows"].to_pylist(), strict=True))
    del table
    tables.drop("sample")
    texts.sort()  # the order of arrival must not matter
    return train(texts)


def held_out(id):
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(5)) == 0


def scores(texts, shared):
    model = shared.value
    ids: dict[bytes, int] = {}
    numbers, counts, results = [], [], np.zeros(len(texts))
    for text in texts:
        words = alnum_words(text)
        numbers.append(np.fromiter(
            (ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)
        ))
        counts.append(len(words))
    if ids and model is not None:
        x = vectors(model, features(list(ids)))
        flat = np.concatenate([*numbers, np.full(WINDOW, len(ids), np.int32)])
        offset = np.cumsum(counts) - counts
        begin = [np.arange(s.start, s.stop, s.step) for s in map(starts, counts)]
        owner = np.repeat(np.arange(len(texts)), [len(b) for b in begin])
        begin = np.concatenate(begin)
        end = np.repeat(counts, [len(starts(c)) for c in counts])
        place = (offset[owner] + begin)[:, None] + np.arange(WINDOW)
        at = flat[np.minimum(place, len(flat) - 1, out=place)]
        at[np.arange(WINDOW) >= (end - begin)[:, None]] = len(ids)
        found = window_scores(model, x, at)
        full, first = np.unique(owner, return_index=True)
        results[full] = np.maximum.reduceat(found, first)
    score = results.astype(np.float64)
    return [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]


def toxicity(
    df: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Score every whole text: the highest score of its overlapping windows.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z in lower case; no other column is
    looked at. Adds score (0 to 1) and predicted (1 if score >= 0.5).

    A text without words, null or empty, scores 0, and so does every text if there is no
    model (no labels of both kinds to train on). Long texts are scored to their end. Repeated
    rows get equal scores; an empty table stays empty. Input columns named like a new one give
    way to it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    return annotate(df, text, keep, "score double, predicted int", scores, shared)
