"""Phrase collocations: pairs of frequency-ranked ids, counted in tiles and paired again."""

from __future__ import annotations

import uuid
from array import array
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import TEXT, Tables, column, pieces, remote

#: A-Z become a-z; the characters that end a piece become line breaks (fixed values).
_PLAIN = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else 0x0A if c in b".,;:!?\n\v\f\r" else c for c in range(256)
)
#: Words of one language that a block of the corpus holds, but for its last text.
BLOCK = 1 << 20
#: Ids on a side of a tile, and the share of its cells that makes a tile dense.
TILE, DENSE = 512, 8
#: Blocks whose distinct pairs fill one group of the merge, about 60 MB at the most.
TOGETHER = 3

#: What is sent between tasks is packed: numbers by the planes of their bytes, words by line.
CHUNK = "chunk string, lang string, seq binary, words binary, counts binary, n long"
#: Rows of blocks (seq) and of what they send to a group of the merge (bucket).
_SENT = [
    ("chunk", pa.string()), ("lang", pa.string()), ("seq", pa.binary()), ("bucket", pa.int32()),
    ("start", pa.int32()), ("words", pa.binary()), ("lefts", pa.binary()),
    ("rights", pa.binary()), ("counts", pa.binary()),
]
SENT = (
    "chunk string, lang string, seq binary, bucket int, start int, words binary, lefts binary, "
    "rights binary, counts binary"
)
#: Rows of what a group found, and of what it tells a block (chunk).
_MERGED = [
    ("chunk", pa.string()), ("bucket", pa.int32()), ("at", pa.binary()), ("places", pa.binary()),
    ("totals", pa.binary()), ("lang", pa.string()), ("found", pa.list_(pa.int64())),
    ("times", pa.list_(pa.int64())), ("words", pa.list_(pa.binary())),
    ("lefts", pa.list_(pa.int64())), ("rights", pa.list_(pa.int64())),
]
MERGED = (
    "chunk string, bucket int, at binary, places binary, totals binary, lang string, "
    "found array<bigint>, times array<bigint>, words array<binary>, lefts array<bigint>, "
    "rights array<bigint>"
)


def _packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, not negative, by the planes of their bytes; of rising ones the steps."""
    values = np.ascontiguousarray(values, np.int64)
    if rising:
        values = np.diff(values, prepend=0)
    planes = values.view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(np.int64).ravel()
    return np.cumsum(values) if rising else values


def _packed_words(words: list[bytes]) -> bytes:
    """Words of which none holds a line break."""
    return zstandard.compress(b"\n".join(words), 1)


def _unpacked_words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b"\n")


def _record(schema: list[tuple[str, pa.DataType]], rows: list[dict]) -> pa.Table:
    return pa.table(
        [pa.array([r.get(n) for r in rows], k) for n, k in schema], names=[n for n, _ in schema]
    )


def _blocks(batches, most):
    """Blocks of the corpus by language: words as numbers within the block from 1, 0 after pieces."""
    open_blocks: dict[str, tuple[dict, array]] = {}

    def closed(lang):
        numbers, seq = open_blocks.pop(lang)
        # numbers follow the words in order, so that like words are stored next to each other
        words = sorted(numbers)
        moved = np.zeros(len(words) + 1, np.int64)  # the last is that of -1
        moved[[numbers[w] for w in words]] = np.arange(1, len(words) + 1)
        seq = moved[np.frombuffer(seq, np.int32)]
        counts = np.bincount(seq, minlength=len(words) + 1)[1:]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]), pa.array([lang]), pa.array([_packed(seq)]),
                pa.array([_packed_words(words)], pa.binary()), pa.array([_packed(counts)]),
                pa.array([int(counts.sum())]),
            ],
            ["chunk", "lang", "seq", "words", "counts", "n"],
        )

    held = 0
    for batch in batches:
        for piece in pieces(batch, TEXT):
            langs = piece.column("lang").to_pylist()
            for lang, text in zip(langs, piece.column(TEXT).to_pylist(), strict=True):
                if not text:
                    continue
                if lang not in open_blocks:
                    open_blocks[lang] = ({}, array("i"))
                numbers, seq = open_blocks[lang]
                before = len(seq)
                number = numbers.setdefault
                for part in text.encode().translate(_PLAIN).split(b"\n"):
                    # what is left of the white space that split() parts at is blank and tab
                    words = part.split()
                    if words:
                        seq.extend([number(w, len(numbers)) for w in words])
                        seq.append(-1)
                held += len(seq) - before
                if len(seq) >= most:
                    held -= len(seq)
                    yield closed(lang)
                elif held >= 4 * most:  # very many languages
                    held = 0
                    for other in [k for k, (_, seq) in open_blocks.items() if seq]:
                        yield closed(other)
    for lang in list(open_blocks):
        if open_blocks[lang][1]:
            yield closed(lang)


def _sent_words(batches, buckets):
    """The words of each block, dealt out to the groups of the merge."""
    for batch in batches:
        for row in batch.to_pylist():
            words = _unpacked_words(row["words"])
            counts = _unpacked(row["counts"])
            dealt = np.fromiter((crc32(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(dealt, kind="stable")
            edges = np.searchsorted(dealt[order], np.arange(buckets + 1))
            rows = []
            for bucket in np.flatnonzero(np.diff(edges)):
                own = order[edges[bucket] : edges[bucket + 1]]
                rows.append({
                    "chunk": row["chunk"], "lang": row["lang"], "bucket": bucket,
                    "words": _packed_words([words[k] for k in own]),
                    "lefts": _packed(own, True), "counts": _packed(counts[own]),
                })
            yield from _record(_SENT, rows).to_batches()


def _ranked(totals: np.ndarray, least: int) -> np.ndarray:
    """Numbers for what occurs `least` times, the most frequent of the group first; else -1."""
    ranks = np.full(len(totals), -1, np.int64)
    often = np.flatnonzero(totals >= least)
    often = often[np.argsort(-totals[often], kind="stable")]
    ranks[often] = np.arange(len(often))
    return ranks


def _identified(bucket: int, ranks):
    """Ids of what a group found; no other group has them."""
    return (bucket << 40) + ranks


def _told(bucket, chunks, places, owners, ranks, totals) -> list[dict]:
    """What each block learns of its entries: their numbers there, ranks in the group, totals."""
    rows, start = [], 0
    for chunk, at in zip(chunks, places, strict=True):
        own = owners[start : start + len(at)]
        start += len(at)
        kept = ranks[own] >= 0
        if kept.any():
            rows.append({
                "chunk": chunk, "bucket": bucket, "at": _packed(at[kept], True),
                "places": _packed(ranks[own][kept]), "totals": _packed(totals[own][kept]),
            })
    return rows


def _merge_words(least):
    def merge(key, table):
        bucket = key[0].as_py()
        numbers: dict[tuple[str, bytes], int] = {}
        owners, counts, places, chunks = [], [], [], []
        for row in table.select(["chunk", "lang", "words", "lefts", "counts"]).to_pylist():
            lang, words = row["lang"], _unpacked_words(row["words"])
            own = [numbers.setdefault((lang, w), len(numbers)) for w in words]
            owners.append(np.array(own, np.int64))
            counts.append(_unpacked(row["counts"]))
            places.append(_unpacked(row["lefts"], True))
            chunks.append(row["chunk"])
        owners = np.concatenate(owners)
        totals = np.zeros(len(numbers), np.int64)
        np.add.at(totals, owners, np.concatenate(counts))
        ranks = _ranked(totals, least)
        rows = _told(bucket, chunks, places, owners, ranks, totals)
        by_lang: dict[str, list[int]] = {}
        entries = list(numbers)
        for k in np.flatnonzero(ranks >= 0):
            by_lang.setdefault(entries[k][0], []).append(k)
        for lang, own in by_lang.items():
            rows.append({
                "lang": lang, "found": _identified(bucket, ranks[own]), "times": totals[own],
                "words": [entries[k][1] for k in own],
            })
        return _record(_MERGED, rows)

    return merge


def _merge_pairs(least):
    def merge(key, table):
        bucket = key[0].as_py()

        sent = [
            (r["start"], _unpacked(r["lefts"], True), _unpacked(r["rights"]), _unpacked(r["counts"]))
            for r in table.select(["start", "lefts", "rights", "counts"]).to_pylist()
        ]
        places = [start + np.arange(len(left)) for start, left, _, _ in sent]
        lefts, rights, counts = (np.concatenate([x[k] for x in sent]) for k in (1, 2, 3))
        del sent
        order = np.lexsort((rights, lefts))
        lefts, rights = lefts[order], rights[order]
        first = np.ones(len(order), bool)
        first[1:] = (lefts[1:] != lefts[:-1]) | (rights[1:] != rights[:-1])
        starts = np.flatnonzero(first)
        totals = np.add.reduceat(counts[order], starts)
        owners = np.empty(len(order), np.int64)
        owners[order] = np.cumsum(first) - 1
        ranks = _ranked(totals, least)
        chunks = table.column("chunk").to_pylist()
        rows = _told(bucket, chunks, places, owners, ranks, totals)
        own = ranks >= 0
        if own.any():
            rows.append({
                "found": _identified(bucket, ranks[own]), "times": totals[own],
                "lefts": lefts[starts][own], "rights": rights[starts][own],
            })
        return _record(_MERGED, rows)

    return merge


def counted(left: np.ndarray, right: np.ndarray, kinds: int):
    """Distinct pairs of ranks below `kinds`, how often each stands there, and which pair each
    place holds.

    Ranks are frequent first, so pairs crowd in the tiles of low ranks. A tile with places for an
    eighth of its cells is counted cell by cell under its own address; the pairs of all others
    are sorted and counted by run.
    """
    side = -(-kinds // TILE) or 1
    tile = (left // TILE) * side + right // TILE
    crowd = np.flatnonzero(np.bincount(tile) >= TILE * TILE // DENSE)
    which = np.empty(len(left), np.int64)
    pairs, times, base = [], [], 0
    rest = np.ones(len(left), bool)
    for number in crowd:
        inside = np.flatnonzero(tile == number)
        rest[inside] = False
        cell = (left[inside] % TILE) * TILE + right[inside] % TILE
        count = np.bincount(cell, minlength=TILE * TILE)
        used = np.flatnonzero(count)
        address = np.empty(TILE * TILE, np.int64)
        address[used] = base + np.arange(len(used))
        which[inside] = address[cell]
        row, place = divmod(used, TILE)
        across, down = divmod(number, side)
        pairs.append(((across * TILE + row) * kinds + down * TILE + place))
        times.append(count[used])
        base += len(used)
    sparse = np.flatnonzero(rest)
    code, inverse, count = np.unique(
        left[sparse] * kinds + right[sparse], return_inverse=True, return_counts=True
    )
    which[sparse] = base + inverse
    pairs.append(code)
    times.append(count)
    return np.concatenate(pairs), np.concatenate(times), which


def _pairs(buckets, keep):
    """Re-rank what occurs often in a block, count the pairs that follow each other, and send
    them to the merge; with `keep`, the block with the pairs' numbers at its places too."""

    def pair(blocks, told):
        rows = []
        known = [
            (_unpacked(r["at"], True), _identified(r["bucket"], _unpacked(r["places"])), _unpacked(r["totals"]))
            for r in told.select(["bucket", "at", "places", "totals"]).to_pylist()
        ]
        if not known:
            return _record(_SENT, rows)
        at, ids, totals = (np.concatenate(x) for x in zip(*known, strict=True))
        order = np.argsort(-totals, kind="stable")
        ids = ids[order]
        for block in blocks.to_pylist():
            seq = _unpacked(block["seq"])
            rank = np.full(max(int(seq.max(initial=0)), int(at.max()) + 1) + 1, -1, np.int64)
            rank[at[order] + 1] = np.arange(len(order))  # places of a block count from 1
            now = rank[seq]
            both = np.flatnonzero((now[:-1] >= 0) & (now[1:] >= 0))
            if not len(both):
                continue
            code, count, which = counted(now[both], now[both + 1], len(ids))
            left, right = (ids[x] for x in divmod(code, len(ids)))
            mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            dealt = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            sent = np.lexsort((right, left, dealt))
            edges = np.searchsorted(dealt[sent], np.arange(buckets + 1))
            if keep:
                # a pair's number in the block is its place among those sent
                number = np.empty(len(sent), np.int64)
                number[sent] = np.arange(1, len(sent) + 1)
                new = np.zeros(len(seq), np.int64)
                new[both] = number[which]
                rows.append({"chunk": block["chunk"], "lang": block["lang"], "seq": _packed(new)})
            for bucket in np.flatnonzero(np.diff(edges)):
                own = sent[edges[bucket] : edges[bucket + 1]]
                rows.append({
                    "chunk": block["chunk"], "bucket": bucket, "start": edges[bucket],
                    "lefts": _packed(left[own], True), "rights": _packed(right[own]),
                    "counts": _packed(count[own]),
                })
        return _record(_SENT, rows)

    return pair


def _worker(maker, *args):
    """`maker(*args)` of this module, imported by name where the task runs."""
    run = remote(_grouped, maker.__name__, args, operator=__name__)
    if maker is _pairs:
        return lambda blocks, told: run((blocks, told))
    return lambda key, table: run((key, table))


def _grouped(given, name, args):
    return globals()[name](*args)(*given)


def candidates(
    df: DataFrame, tables: Tables, text: str = "text", lang: str = "lang", longest: int = 4,
    least: int = 30, block: int = BLOCK,
) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1 to `longest` words with `least` occurrences, a table for each length, and the
    number of words of each language.

    A phrase's row has id, lang, phrase, a (its occurrences), `heads` and `tails` (the occurrences
    of its first and last 1, 2, ... words), and left and right: the ids of the phrases without its
    last and its first word.
    """
    source = df.select(
        F.coalesce(column(lang).cast("string"), F.lit("und")).alias("lang"),
        column(text).cast("string").alias(TEXT),
    )
    blocks = tables.write("blocks", source.mapInArrow(remote(_blocks, block), CHUNK))
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    buckets = -(-blocks.select("chunk").count() // TOGETHER) or 1

    sent = blocks.select("chunk", "lang", "words", "counts").mapInArrow(
        remote(_sent_words, buckets), SENT
    )
    merged = tables.write(
        "merged1", sent.groupBy("bucket").applyInArrow(_worker(_merge_words, least), MERGED)
    )
    found = merged.where("chunk IS NULL").select(
        "lang", F.explode(F.arrays_zip("found", "times", "words")).alias("e")
    )
    word, times = F.col("e.words").cast("string"), F.array("e.times")
    phrases = [
        tables.write(
            "phrases1",
            found.select(
                F.col("e.found").alias("id"), "lang", word.alias("phrase"), word.alias("last"),
                F.col("e.times").alias("a"), times.alias("heads"), times.alias("tails"),
                F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"),
            ),
        )
    ]
    seqs = blocks.select("chunk", "lang", "seq")
    for size in range(2, longest + 1):
        told = merged.where("chunk IS NOT NULL").select("chunk", "bucket", "at", "places", "totals")
        sent = (
            seqs.groupBy("chunk")
            .cogroup(told.groupBy("chunk"))
            .applyInArrow(_worker(_pairs, buckets, size < longest), SENT)
        )
        sent = tables.write(f"sent{size}", sent)
        merged = tables.write(
            f"merged{size}",
            sent.where("bucket IS NOT NULL").select(*[n for n, _ in _SENT])
            .groupBy("bucket").applyInArrow(_worker(_merge_pairs, least), MERGED),
        )
        seqs = sent.where("seq IS NOT NULL").select("chunk", "lang", "seq")
        found = merged.where("chunk IS NULL").select(
            F.explode(F.arrays_zip("found", "times", "lefts", "rights")).alias("e")
        ).select(
            F.col("e.found").alias("id"), F.col("e.times").alias("a"),
            F.col("e.lefts").alias("left"), F.col("e.rights").alias("right"),
        )
        shorter = phrases[-1]
        front = shorter.select(F.col("id").alias("left"), "lang", "phrase", "heads")
        back = shorter.select(F.col("id").alias("right"), "last", "tails")
        phrases.append(
            tables.write(
                f"phrases{size}",
                found.join(front, "left").join(back, "right").select(
                    "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a",
                    F.concat("heads", F.array("a")).alias("heads"),
                    F.concat("tails", F.array("a")).alias("tails"), "left", "right",
                ),
            )
        )
        tables.drop(*([f"sent{size - 1}"] if size > 2 else []), f"merged{size - 1}")
    sizes = tables.write("sizes", sizes)
    tables.drop("blocks", *([f"sent{longest}", f"merged{longest}"] if longest > 1 else ["merged1"]))
    return phrases, sizes


def _cuts(size: int) -> Column:
    """The cut of a phrase of this many words that scores least, the first of those that tie."""
    cuts = []
    for k in range(1, size):
        left, right = f"heads[{k - 1}]", f"tails[{size - k - 1}]"
        # 20 digits times 7 fit into a decimal, whose whole division is exact
        score = (
            "cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div "
            f"(cast({left} as decimal(20,0)) + cast({right} as decimal(20,0)))"
        )
        cuts.append(
            F.struct(
                F.expr(score).alias("score"), F.lit(k).alias("k"),
                F.expr(left).alias("l"), F.expr(right).alias("r"),
            )
        )
    return F.array_min(F.array(*cuts))


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30,
    most: int | None = 2000, block: int = BLOCK,
) -> DataFrame:
    """The phrases of each language whose words stand together more than their parts let expect.

    Texts, A-Z in lower case, are split at `.,;:!?` and line ends into pieces, these at blanks and
    tabs into words. Phrases of 2 to `longest` words of a piece with a >= `least` occurrences are
    scored: cutting one gives l and r, the occurrences of both parts, and 2,000,000 a / (l + r),
    rounded down; its lowest cut counts, of those that tie the first. Phrases inside a longer one
    that has four occurrences in five of theirs are dropped. Gives the `most` (all if None) best of
    each language by score, a and phrase: lang, rank, phrase, a, l, r, n (words of the language)
    and score.

    The corpus is laid down once as blocks of word numbers. For each length, what occurs often in
    all blocks is ranked by frequency in each block, pairs of ranks that follow each other are
    counted in tiles, and the counts are added up over the blocks by pair; frequent pairs are
    the words of the next length.

    A null language is `und`; null and empty texts have no words; repeated rows count each;
    an empty table gives no rows. Other columns play no part.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    tables = Tables(df.sparkSession, "collocations")
    phrases, sizes = candidates(df, tables, text, lang, longest, least, block)
    scored = []
    for size in range(2, longest + 1):
        own = phrases[size - 1].withColumn("cut", _cuts(size))
        if size < longest:
            # a longer phrase around one is never more frequent than the one longer by a word
            around = phrases[size].select(F.explode(F.array("left", "right")).alias("id"), "a")
            around = around.groupBy("id").agg(F.max("a").alias("__longer"))
            own = own.join(around, "id", "left").where(
                "__longer IS NULL OR cast(100 as decimal(3,0)) * cast(__longer as decimal(20,0))"
                " < cast(80 as decimal(3,0)) * cast(a as decimal(20,0))"
            )
        scored.append(own.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(best).cast("long"))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
