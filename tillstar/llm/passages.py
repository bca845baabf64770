"""Substring dedup by hashing lines and the sentences in them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import TEXT, Tables, alnum_words, column, parts, pieces, remote

#: Marks that end a sentence without white space after them: ideographic, full and half width,
#: Arabic, Indic, Armenian, Ethiopic, Burmese, Khmer, Tibetan, Mongolian and doubled ones.
MARKS = (
    "\u3002\uff01\uff0e\uff1f\uff61\u061f\u06d4\u0964\u0965\u0589\u1362\u1367\u1368\u104b"
    "\u17d4\u17d5\u0f0d\u0f0e\u1803\u1809\u203c\u2047\u2048\u2049"
)
#: Closing quotes and brackets that belong to the sentence before them.
CLOSING = "\"')\\]}\u00bb\u201d\u2019\u203a\u3009\u300b\u300d\u300f\u3011\u3015\uff09\uff3d\uff63"
#: What may end a unit: a run of punctuation, taken whole so that no text makes it be read again,
#: or the end of a line. The white space after it belongs to the unit.
BREAK = re.compile(r"[^\w\s]++|[\n\u2028\u2029]\s*+")
SPACES = re.compile(r"\s*+")
MARK, OTHER = re.compile(f"[.!?{MARKS}]"), re.compile(f"[{MARKS}]")
CLOSED = re.compile(f"[{MARKS}][{MARKS}.!?]*+[{CLOSING}]*+")
#: Words that a run of repeated units must have to be removed, or else letters of scripts that put
#: no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Tai, kana, Han, Yi, Javanese.
LEAST, LETTERS = 10, 50
#: Repeated units that a task makes spans of at once; a text of more is done on its own.
UNITS = 1 << 16
UNSPACED = re.compile(
    "[\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u0edc-\u0edf\u0f40-\u0fbc\u1000-\u103f\u1050-\u108f"
    "\u1780-\u17d3\u1950-\u19c9\u1a20-\u1a7c\u1b05-\u1b4c\u3005-\u3007\u3041-\u3096\u309d-\u309f"
    "\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\ua000-\ua48c\ua984-\ua9c0\uaa60-\uaadd\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af]+"
)


def unspaced(text: str) -> int:
    """Letters of a text in scripts without spaces between words."""
    return 0 if text.isascii() else len(text) - len(UNSPACED.sub("", text))


def ends(text: str):
    """Where units of a text end: with their line, or with a sentence in it.

    A sentence ends with `.`, `!` or `?` if only punctuation stands between them and white space,
    or with one of MARKS, whatever follows; closing quotes and brackets belong to it.
    """
    for found in BREAK.finditer(text):
        at, stop = found.span()
        if text[at].isspace():
            yield stop
            continue
        over = SPACES.match(text, stop).end()
        at = MARK.search(text, at, stop)
        while at is not None:
            if text[at.start()] in ".!?":
                if over > stop:
                    yield over
                    break
                # followed by a letter: only the other marks may still end a sentence
                at = OTHER.search(text, at.end(), stop)
            else:
                end = CLOSED.match(text, at.start(), stop).end()
                yield over if end == stop else end
                at = MARK.search(text, end, stop)


def units(text: str | None):
    """(start, end, words, digest) of the units of a text that have words.

    Units are normalised before the digest: words of letters and digits, A-Z in lower case,
    one space between them. Offsets are code points of the text as it is.
    """
    if not text:
        return
    start = 0
    for end in [*ends(text), len(text)]:
        if end > start:
            words = alnum_words(text[start:end])
            if words:
                yield start, end, len(words), xxhash.xxh3_128_digest(b" ".join(words))
        start = end


def _units(batches, places):
    """One row for each unit; without `places`, its digest, text and number alone."""
    for batch in batches:
        for piece in pieces(batch, TEXT):
            rows, number, starts, ends, sizes, letters, digests = [], [], [], [], [], [], []
            for row, text in enumerate(piece.column(TEXT).to_pylist()):
                for at, (start, end, words, digest) in enumerate(units(text)):
                    rows.append(row)
                    number.append(at)
                    digests.append(digest)
                    if places:
                        starts.append(start)
                        ends.append(end)
                        sizes.append(words)
                        letters.append(unspaced(text[start:end]))
            take = pa.array(rows, pa.int64())
            made = [
                pa.array(digests, pa.binary()),
                piece.column("id").take(take), piece.column("hash").take(take),
                pa.array(number, pa.int32()),
            ]
            names = ["digest", "id", "hash", "at"]
            if places:
                made += [pa.array(x, pa.int32()) for x in (starts, ends, sizes, letters)]
                names += ["start", "end", "words", "letters"]
            yield pa.RecordBatch.from_arrays(made, names)


def _spans(batches, least, letters):
    """Runs of repeated units that follow each other, from all repeated units of a text."""
    for batch in batches:
        sizes = np.diff(batch.column("units").offsets.to_numpy())
        for piece in parts(batch, sizes.tolist(), UNITS):
            lists = piece.column("units")
            offsets = lists.offsets.to_numpy()
            units = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            row = np.repeat(np.arange(len(lists)), np.diff(offsets))
            at = units.field("at").to_numpy()
            order = np.lexsort((at, row))  # units in their texts' order; rows stay in place
            at = at[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(at)) - 1
            words, signs = (
                np.add.reduceat(units.field(n).to_numpy()[order], first, dtype=np.int64)
                for n in ("words", "letters")
            )
            long = (words >= least) | (signs >= letters)
            first, last, words = first[long], last[long], words[long]
            made = [
                units.field("start").take(pa.array(order[first])),
                units.field("end").take(pa.array(order[last])),
                pa.array(words, pa.int32()),
                units.field("kept_id").take(pa.array(order[first])),
            ]
            kind = lists.type.value_type
            fields = [kind.field(n) for n in ("start", "end", "words", "kept_id")]
            bounds = np.searchsorted(row[first], np.arange(len(lists) + 1))
            spans = pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(made, fields=fields)
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("hash"), spans], ["id", "hash", "spans"]
            )


def repeated_spans(
    df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST,
    letters: int = LETTERS,
) -> DataFrame:
    """Passages of each text that stand in an earlier one, or earlier in itself.

    Units of all texts are grouped by digest; the first in the order of id, hash of the text
    and place is kept, all others are repeated. Repeated units that follow each other in a text
    form a span if they have `least` words together, or `letters` letters of scripts without
    spaces between words (of which a whole sentence counts as one word). Gives one row a text
    that has spans: id, hash (of the text) and spans (start, end in code points, words, kept_id:
    where the span's first unit is kept).

    A null or empty text has no units. Null ids rank after all others and are told apart by
    their texts. Rows that repeat both id and text are one text: they get the same spans and
    don't repeat each other. An empty table gives no rows. Other columns play no part.
    """
    source = df.select(
        column(id).alias("id"), F.xxhash64(column(text)).alias("hash"),
        column(text).cast("string").alias(TEXT),
    )
    kind = source.schema["id"].dataType
    key = [
        T.StructField("digest", T.BinaryType()), T.StructField("id", kind),
        T.StructField("hash", T.LongType()), T.StructField("at", T.IntegerType()),
    ]
    sizes = ("start", "end", "words", "letters")
    where = [T.StructField(n, T.IntegerType()) for n in sizes]
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "at")
    # written, so that the join below has a shuffle on both sides and its hot digests can be split
    first = Tables(df.sparkSession, "passages").write(
        "first",
        source.mapInArrow(remote(_units, False), T.StructType(key))
        .groupBy("digest")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select("digest", "first"),
    )
    found = source.mapInArrow(remote(_units, True), T.StructType(key + where))
    repeated = (
        found.join(first, "digest")
        .where(rank != F.col("first"))
        .groupBy("id", "hash")
        .agg(
            F.collect_set(
                F.struct("at", *sizes, F.col("first.id").alias("kept_id"))
            ).alias("units")
        )
    )
    span = T.StructType([*where[:-1], T.StructField("kept_id", kind)])
    schema = T.StructType([key[1], key[2], T.StructField("spans", T.ArrayType(span))])
    return repeated.mapInArrow(remote(_spans, least, letters), schema).where(F.size("spans") > 0)


def _without(batches, text):
    for batch in batches:
        names = batch.schema.names
        kept = [n for n in names if n != "__llm_spans"]
        for piece in pieces(batch, text):
            texts, made = piece.column(names.index(text)).to_pylist(), []
            for whole, spans in zip(texts, piece.column("__llm_spans").to_pylist(), strict=True):
                last, uncut = 0, []
                for span in sorted(spans or (), key=lambda s: s["start"]):
                    uncut.append(whole[last : span["start"]])
                    last = span["end"]
                made.append("".join([*uncut, whole[last:]]) if uncut else whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.string()) if n == text else piece.column(n) for n in kept], kept
            )


def without_repeats(
    df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST,
    letters: int = LETTERS,
) -> DataFrame:
    """The table with every repeated span cut out of its texts; each row stays.

    Nulls, ties, repeated rows and empty tables as in `repeated_spans`; a text that is
    removed whole becomes empty.
    """
    spans = repeated_spans(df, id, text, least, letters).select(
        F.col("id").alias("__llm_id"), F.col("hash").alias("__llm_hash"),
        F.col("spans").alias("__llm_spans"),
    )
    joined = df.join(
        spans,
        column(id).eqNullSafe(F.col("__llm_id"))
        & (F.xxhash64(column(text)) == F.col("__llm_hash")),
        "left",
    ).select(*[column(c) for c in df.columns], "__llm_spans")
    return joined.mapInArrow(remote(_without, text), df.schema)
