"""Byte-level BPE: encoding by a rank queue on a hierarchical bitmap, and decoding."""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillstar.llm.common import annotate, memory, remote

#: A worker remembers the pre-tokens it has met; beyond so many they become the old ones, and the
#: old ones before them that weren't met again are forgotten.
CACHE = 300_000
#: Characters from which a pre-token is not remembered.
LONG = 64
#: A vocabulary beyond this is not a public tokenizer's and won't be sent to the executors.
MOST_VOCABULARY = 64 << 20


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked pair first, of equal ones the leftmost.

    Symbols are a linked list by start position (`after`, `before`). The queue of pairs has a
    bucket for each rank, a linked list (position, rest) of positions, and two levels of
    bitmaps over the buckets: bit h of `top` says that `low[h]` has a bit, bit b of `low[h]`
    that bucket 256 * h + b has positions. Find-first-set on both gives the smallest rank.
    `now[i]` is the present rank of the pair that starts at i; a queued position of another
    rank is stale and skipped.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    size, get = len(piece), ranks.get
    after, before = list(range(1, size + 2)), list(range(-1, size))
    now = [get(piece[i : i + 2]) for i in range(size - 1)]
    now.append(None)
    top, low, bucket = 0, {}, {}
    for i, rank in enumerate(now):
        if rank is None:
            continue
        rest = bucket.get(rank)
        bucket[rank] = i, rest
        if rest is None:
            high = rank >> 8
            top |= 1 << high
            low[high] = low.get(high, 0) | 1 << (rank & 255)
    while top:
        high = (top & -top).bit_length() - 1
        bits = low[high]
        first = bits & -bits
        rank = high << 8 | first.bit_length() - 1
        bits ^= first
        low[high] = bits
        if not bits:
            top &= top - 1
        node = bucket.pop(rank)
        if node[1] is None:
            positions = [node[0]]
        else:
            positions = []
            while node is not None:
                positions.append(node[0])
                node = node[1]
            positions.sort()
        fresh, lower = [], False
        for done, i in enumerate(positions, 1):
            if now[i] != rank:
                continue
            j = after[i]
            k = after[j]
            after[i], now[j] = k, None
            before[k] = i
            now[i] = new = get(piece[i : after[k]]) if k < size else None
            if new is not None:
                fresh.append((new, i))
                lower = new <= rank
            p = before[i]
            if p >= 0:
                new = get(piece[p:k])
                if new != now[p]:
                    now[p] = new
                    if new is not None:
                        fresh.append((new, p))
                        lower = lower or new <= rank
            if lower:  # a new pair goes before the rest of this rank
                fresh += [(rank, i) for i in positions[done:]]
                break
        for new, i in fresh:
            rest = bucket.get(new)
            bucket[new] = i, rest
            if rest is None:
                high = new >> 8
                top |= 1 << high
                low[high] = low.get(high, 0) | 1 << (new & 255)
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Encoder:
    """Encoding and decoding by a table of byte strings and ranks."""

    def __init__(self, table: bytes, pattern: str):
        rows = (line.split() for line in table.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.words = {rank: token for token, rank in self.ranks.items()}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary must have every single byte")
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE:
            self.known, self.old = {}, self.known
        known, old, ranks, out = self.known, self.old, self.ranks, []
        for piece in self.find(text):
            ids = known.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    ids = array("I", merge(piece.encode(), ranks)).tobytes()
                if len(piece) < LONG:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, array("I", ids)))


_encoders: dict[str, Encoder] = memory(__name__)


def encoder(shared, pattern: str) -> Encoder:
    """The encoder of a broadcast (key, table), made once in each worker."""
    key, table = shared.value
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(table, pattern)
    return _encoders[key]


def codes(texts, shared, pattern, with_ids):
    coder = encoder(shared, pattern)
    counts, sums, backs, packed = [], [], [], []
    for text in texts:
        ids = coder.encode(text or "")
        counts.append(len(ids) // 4)
        sums.append(hashlib.sha256(ids).hexdigest())
        backs.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        if with_ids:
            packed.append(ids)
    made = [pa.array(counts, pa.int64()), pa.array(sums), pa.array(backs)]
    made = [m.cast(pa.string()) if m.type == pa.null() else m for m in made]
    if with_ids:
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        values = np.frombuffer(b"".join(packed), np.int32)
        made.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
    return made


def share_file(spark, path: str, pattern: str = ""):
    """Broadcast of a vocabulary file, whose size is checked."""
    with open(path, "rb") as file:
        table = file.read(MOST_VOCABULARY + 1)
    if len(table) > MOST_VOCABULARY:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY} bytes")
    key = hashlib.sha256(table + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast((key, table))


def encode(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Adds n_tokens, ids_sha256 (hex of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (hex of the decoded bytes) and, unless `with_ids` is false, ids.
    Each match of `pattern` is merged alone; characters that it doesn't match are left out.

    A null text counts as empty: no ids, and the digests of nothing. A text of any length is
    encoded whole. Repeated rows and ties each get their own row; an empty table stays
    empty. Input columns named like a new column give way to it.
    """
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields += ", ids array<int>" * with_ids
    shared = share_file(df.sparkSession, vocabulary, pattern)
    return annotate(df, text, keep, fields, codes, shared, pattern, with_ids)


def _decoded(batches, ids, to, shared):
    coder = encoder(shared, "")
    for batch in batches:
        kept = [c for c in batch.schema.names if c.lower() != to.lower()]
        rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
        backs = [None if row is None else coder.decode(array("I", row).tobytes()) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(backs, pa.binary())], kept + [to]
        )


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the bytes that each array of ids stands for; null gives null, no ids no bytes."""
    shared = share_file(df.sparkSession, vocabulary)
    fields = [f for f in df.schema if f.name.lower() != to.lower()]
    schema = T.StructType([*fields, T.StructField(to, T.BinaryType())])
    return df.mapInArrow(remote(_decoded, ids, to, shared), schema)
