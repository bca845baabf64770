"""What the operators share: running Python on batches of texts, words, and scratch tables."""

from __future__ import annotations

import importlib
import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sinks.writers import drop_folders, shared_folder

ROOT = str(Path(__file__).resolve().parents[2])
TEXT = "__llm_text"
#: Bytes of text that a task works on at once; a longer text is a piece of its own.
PIECE = 4 << 20

_UPPER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: A-Z become a-z; ASCII bytes that are neither letters nor digits become spaces.
_ALNUM = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A
    else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else 0x20
    for c in range(256)
)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; other letters stay."""
    return (text or "").encode().translate(_UPPER)


def space_words(text: str | None) -> list[bytes]:
    r"""Words `[^\x20\x09-\x0D]+`, A-Z in lower case: bytes.split parts at just these six."""
    return lowered(text).split()


def alnum_words(text: str | None) -> list[bytes]:
    r"""Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, A-Z in lower case."""
    return (text or "").encode().translate(_ALNUM).split()


def runs_of(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values that are `least` long or longer."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as sorted spans that neither touch nor overlap."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[first], reach[np.concatenate((first[1:], [True]))]


def parts(batch: pa.RecordBatch, sizes: Sequence[int], most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows have sizes of at most `most` together, or one row."""
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most PIECE bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    yield from parts(batch, sizes.tolist(), PIECE)


#: What workers remember between tasks, by operator. A worker serves many operators in turn and
#: remembers for one at a time.
_memories: dict[str, list[dict]] = {}


def memory(operator: str) -> dict:
    """A dictionary that lasts until the worker turns to another operator."""
    found: dict = {}
    _memories.setdefault(operator, []).append(found)
    return found


def _turn_to(operator: str) -> None:
    for name, kept in _memories.items():
        if name != operator:
            for one in kept:
                one.clear()


def remote(function, *args, operator: str | None = None):
    """A task function that imports `function` by name.

    It also looks where the driver has this package, for sessions that don't ship it.
    """
    module, name, root = function.__module__, function.__name__, ROOT
    operator = operator or module

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        importlib.import_module("tillstar.llm.common")._turn_to(operator)
        return getattr(importlib.import_module(module), name)(batches, *args)

    return run


def annotated(
    batches: Iterable[pa.RecordBatch], text: str, module: str, name: str, fields: Sequence[str],
    *args,
) -> Iterator[pa.RecordBatch]:
    """Carried columns and what `module.name(texts, *args)` gives for each piece of a batch."""
    function = getattr(importlib.import_module(module), name)
    for batch in batches:
        for piece in pieces(batch, text):
            made = function(piece.column(text).to_pylist(), *args)
            kept = [c for c in piece.schema.names if c != TEXT]
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in kept] + list(made), kept + list(fields)
            )


def annotate(
    df: DataFrame, text: str, keep: Sequence[str] | None, fields: str, function, *args
) -> DataFrame:
    """`keep` (default: all columns) and the new columns of a DDL schema.

    `function(texts, *args)` gives one Arrow array a field. An input column with the name
    of a new column gives way to it.
    """
    added = T.StructType.fromDDL(fields)
    new = {f.name.lower() for f in added}
    carried = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    # a text that is carried is not sent twice
    twice = text in carried and df.schema[text].dataType == T.StringType()
    extra = [] if twice else [column(text).cast("string").alias(TEXT)]
    source = df.select(*[column(c) for c in carried], *extra)
    schema = T.StructType([source.schema[c] for c in carried] + list(added))
    module = function.__module__
    work = remote(
        annotated, text if twice else TEXT, module, function.__name__, added.names, *args,
        operator=module,
    )
    return source.mapInArrow(work, schema)


def column(name: str):
    """Column by its plain name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


class Tables:
    """Tables that one operator writes to the shared folder, so that no later step repeats
    the work before it and a lost executor costs only its own tasks.

    `drop` deletes what the result doesn't read; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.paths: dict[str, str] = {}
        self.base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        self.paths[name] = path
        return self.read(name, df.schema)

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        drop_folders(self.spark, *[self.paths.pop(n) for n in names])
