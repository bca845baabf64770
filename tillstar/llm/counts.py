"""Token counts by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillstar.llm.bpe import share_file
from tillstar.llm.common import annotate, memory

#: Pre-tokens whose counts a worker remembers; all are forgotten when there are more.
CACHE = 1_000_000
#: Characters from which a pre-token is not remembered.
LONG = 64
#: What byte-level pre-tokenizers split by (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it is printable
    in Latin-1, else the next letter from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts of one vocabulary file."""

    def __init__(self, table: bytes):
        file = json.loads(table)
        model, split = file["model"], file["pre_tokenizer"] or {}
        if (
            model["type"] != "BPE" or split.get("type") != "ByteLevel" or file["normalizer"]
            or not split.get("use_regex", True) or split.get("add_prefix_space")
            or model.get("ignore_merges") or model.get("dropout")
        ):
            raise ValueError("only plain byte-level BPE files can be counted")
        added = file.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens that take in their surroundings can't be counted")
        strings = sorted((t["content"] for t in added if t["content"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, strings))) if strings else None
        ids = model["vocab"]
        self.symbol = np.array([ids[c] for c in byte_letters()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols, NONE where there is no merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """Symbols that each byte string keeps.

        All strings lie in one array `sym`; `rank[i]` belongs to the pair (i, i + 1) and is NONE
        at the end of a string. Each round merges in every string all occurrences of its lowest
        rank, from the left where they overlap; strings without a merge leave.
        """
        size = np.array([len(w) for w in words], np.int64)
        result = size.copy()
        who = np.flatnonzero(size > 1)
        if not len(who):
            return result
        sym = self.symbol[np.frombuffer(b"".join(words[i] for i in who.tolist()), np.uint8)]
        size = size[who]
        rank = np.full(len(sym), NONE, np.int32)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = NONE
        while True:
            lowest = np.minimum.reduceat(rank, np.cumsum(size) - size)
            going = lowest != NONE
            if not going.all():
                result[who[~going]] = size[~going]
                if not going.any():
                    return result
                stay = np.repeat(going, size)
                sym, rank = sym[stay], rank[stay]
                who, size, lowest = who[going], size[going], lowest[going]
            hit = rank == np.repeat(lowest, size)
            if (hit[1:] & hit[:-1]).any():  # "aaa": take every other one of a run
                at = np.arange(len(hit))
                start = np.maximum.accumulate(np.where(~hit, at + 1, 0))
                hit &= (at - start) % 2 == 0
            places = np.flatnonzero(hit)
            sym[places] = self.made[rank[places]]
            stay = np.ones(len(sym), bool)
            stay[places + 1] = False
            last = np.zeros(len(sym), bool)
            last[np.cumsum(size) - 1] = True
            last[places] |= last[places + 1]
            gone = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
            size = size - gone
            moved = np.cumsum(stay)[places] - 1
            sym, rank, last = sym[stay], rank[stay], last[stay]
            again = np.concatenate((moved, moved[moved > 0] - 1))
            again = again[~last[again]]
            rank[moved] = NONE
            rank[again] = self.ranks(sym[again], sym[again + 1])
            rank[last] = NONE

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; the new pre-tokens of all texts are merged together."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        found, extra, new = [], [], {}
        for text in texts:
            parts, more = [text or ""], 0
            if self.special is not None and text:
                parts = self.special.split(text)
                more = len(parts) - 1
            tokens = [t for part in parts for t in self.find(part)]
            found.append(tokens)
            extra.append(more)
            for t in tokens:
                if t not in known:
                    new[t] = 0
        if new:
            strings = list(new)
            counts = self.lengths([t.encode() for t in strings]).tolist()
            fresh = dict(zip(strings, counts, strict=True))
            known.update(fresh)
        totals = [sum(map(known.__getitem__, tokens)) for tokens in found]
        for t in new:
            if len(t) >= LONG:
                del known[t]
        return [a + b for a, b in zip(totals, extra, strict=True)]


_counters: dict[str, Counter] = memory(__name__)


def tallies(texts, shared, limit):
    key, table = shared.value
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(table)
    totals = _counters[key].count(texts)
    return [
        pa.array([len((t or "").encode()) for t in texts], pa.int64()),
        pa.array(totals, pa.int64()),
        pa.array([n > limit for n in totals], pa.bool_()),
    ]


def token_counts(
    df: DataFrame,
    vocabulary: str,
    limit: int = 1024,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Count the tokens of every whole text by a byte-level BPE file of the tokenizers library.

    Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit). Strings of added tokens
    inside a text count as one token each, as that library takes them by default.

    A null text counts as empty: no bytes, no tokens. Texts and pre-tokens of any length are
    counted whole. Repeated rows and ties each get their own row; an empty table stays empty.
    Input columns named like a new column give way to it.
    """
    shared = share_file(df.sparkSession, vocabulary)
    fields = "n_bytes long, n_tokens long, over_limit boolean"
    return annotate(df, text, keep, fields, tallies, shared, limit)
