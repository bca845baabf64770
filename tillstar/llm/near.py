"""Near-duplicates by MinHash signatures and a multi-index Hamming join, confirmed on full sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.llm.common import TEXT, Tables, column, pieces, remote, space_words

#: Components of a signature of 16 bits each, and chunk errors that are enumerated: a key holds three
#: components or more, so at least 48 bits, and nodes share one by chance only among many millions.
COMPONENTS, ERRORS = 64, 1
#: Chance that a pair just at the similarity is further apart than the signature distance.
MISS = 1e-5
#: Rounds that link bucket members to a drawn member before what remains is compared in full, and
#: shingles of each side of a block in which it is.
ROUNDS, BLOCK = 2, 2_000_000

_draw = np.random.default_rng(64)
_MULTIPLY = _draw.integers(0, 1 << 32, COMPONENTS, np.uint32) | np.uint32(1)
_ADD = _draw.integers(0, 1 << 32, COMPONENTS, np.uint32)
_KEY = _draw.integers(0, 1 << 64, COMPONENTS, np.uint64) | np.uint64(1)
_PLACE = _draw.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distance(trials: int, chance: float, miss: float = MISS) -> int:
    """The least d that a binomial variable exceeds with a chance of `miss` at most."""
    tail = 1.0
    for d in range(trials + 1):
        tail -= math.comb(trials, d) * chance**d * (1 - chance) ** (trials - d)
        if tail <= miss:
            return d
    return trials


def chunks(similarity: float) -> list[np.ndarray]:
    """Components by chunk: so many chunks that a pair within the signature distance has a
    chunk with ERRORS differing components at most (pigeonhole)."""
    most = distance(COMPONENTS, 1 - similarity)
    return np.array_split(np.arange(COMPONENTS), min(COMPONENTS, most // (ERRORS + 1) + 1))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    Of a text with fewer words than a shingle has, the whole sequence is the only one.
    """
    words = space_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for at in range(width):
        total += hashes[at : at + count] * _PLACE[at % 64]
    return np.unique(mixed(total))


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of the least value of each of COMPONENTS hash functions."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.empty(COMPONENTS, np.uint32)
    for i in range(0, COMPONENTS, 8):
        values = low[None, :] * _MULTIPLY[i : i + 8, None] + _ADD[i : i + 8, None]
        least[i : i + 8] = values.min(1)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _signed(batches, size):
    """Digest and number of the shingles, signature, and its lowest bits as a sketch."""
    for batch in batches:
        for piece in pieces(batch, TEXT):
            digests, counts, signs, sketches = [], [], [], []
            for text in piece.column(TEXT).to_pylist():
                found = shingles(text, size)
                counts.append(len(found))
                if not len(found):
                    digests.append(None)
                    signs.append(None)
                    sketches.append(None)
                    continue
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sign = signature(found)
                signs.append(sign.tobytes())
                bits = np.packbits((sign[:64] & 1).astype(np.uint8))
                sketches.append(int.from_bytes(bits.tobytes(), "big", signed=True))
            kept = [n for n in piece.schema.names if n != TEXT]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(n) for n in kept), pa.array(digests, pa.binary()),
                 pa.array(counts, pa.int64()), pa.array(signs, pa.binary()),
                 pa.array(sketches, pa.int64())],
                [*kept, "digest", "size", "sign", "sketch"],
            )


def _keyed(batches, similarity):
    """All keys of a signature: for each chunk and each choice of ERRORS of its components, the
    chunk number, the choice and the other components, hashed to 64 bits."""
    parts = chunks(similarity)
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint16)
        terms = signs.reshape(-1, COMPONENTS).astype(np.uint64) * _KEY[None, :]
        keys = []
        for number, part in enumerate(parts):
            whole = terms[:, part].sum(1, dtype=np.uint64)
            for wild in part.tolist():
                salt = mixed(np.array([number * 1000 + wild], np.uint64))
                keys.append(mixed(whole - terms[:, wild] + salt))
        flat = np.stack(keys, 1).view(np.int64).ravel()
        width = len(keys)
        offsets = pa.array(np.arange(0, len(flat) + 1, width), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
        kept = [n for n in batch.schema.names if n != "sign"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), lists], [*kept, "keys"])


def _sets(batches, size):
    for batch in batches:
        for piece in pieces(batch, TEXT):
            sets = [shingles(t, size).view(np.int64) for t in piece.column(TEXT).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "set"]
            )


def _compared(table: pa.Table, percent: int) -> pa.Table:
    """Components (a, b) that a pair of an outer and an inner node links, on full sets."""
    outer = table["outer"].to_numpy(zero_copy_only=False).astype(bool)
    node, comp = (table[c].to_numpy() for c in ("node", "comp"))
    sets = table["set"].combine_chunks()
    begins = sets.offsets.to_numpy().astype(np.int64)
    shingle_ids, flat = np.unique(sets.values.to_numpy(), return_inverse=True)
    flat = flat[begins[0] :] if begins[0] else flat
    begins -= begins[0]
    sizes = np.diff(begins)
    inner = np.flatnonzero(~outer)
    links = set()
    if len(inner):
        counts = sizes[inner]
        start = np.cumsum(counts) - counts
        place = np.repeat(begins[inner] - start, counts) + np.arange(counts.sum())
        theirs = flat[place]
        mark = np.zeros(len(shingle_ids), np.int64)
        for x in np.flatnonzero(outer).tolist():
            own = flat[begins[x] : begins[x + 1]]
            mark[own] = 1
            both = np.add.reduceat(mark[theirs], start)
            mark[own] = 0
            near = 100 * both >= percent * (counts + sizes[x] - both)
            near &= (comp[inner] != comp[x]) & (node[inner] != node[x])
            for other in comp[inner[near]].tolist():
                links.add((min(int(comp[x]), other), max(int(comp[x]), other)))
    a, b = zip(*sorted(links), strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def linked_in_families(
    tables: Tables, sets: DataFrame, labels: DataFrame, families: DataFrame, percent: int, block: int = BLOCK
) -> DataFrame:
    """Links (a, b) between components of one family, which is compared in full.

    Outer nodes are those outside a family's largest component; each is compared with every
    node of another component. Both sides are cut into blocks of about `block` shingles, and
    every pair of blocks is a task of its own that gives links alone, so neither a large
    family nor its pairs meet in one place.
    """
    members = sets.join(labels, "node").join(
        families.withColumnRenamed("comp", "family"), "node"
    )
    weight = F.size("set").cast("long")
    by_comp = members.groupBy("family", "comp").agg(
        F.count(F.lit(1)).alias("nodes"), F.sum(weight).alias("weight")
    )
    # written, so that a large family's members can be split in the join with it
    plan = tables.write(
        "plan",
        by_comp.groupBy("family")
        .agg(
            F.max(F.struct("nodes", "comp")).alias("most"),
            F.max_by("weight", F.struct("nodes", "comp")).alias("inside"),
            F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("comps"),
        )
        .where("comps > 1")
        .select(
            "family", F.col("most.comp").alias("major"),
            F.ceil((F.col("weight") - F.col("inside")) / block).cast("int").alias("rows"),
            F.ceil(F.col("weight") / block).cast("int").alias("columns"),
        ),
    )
    placed = members.join(plan, "family")
    row = F.pmod(F.xxhash64("node"), F.col("rows")).cast("int")
    column_ = F.pmod(F.xxhash64("node"), F.col("columns")).cast("int")
    outer = placed.where("comp <> major").select(
        "family", row.alias("row"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
        F.lit(True).alias("outer"), "node", "comp", "set",
    )
    inner = placed.select(
        "family", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        column_.alias("column"), F.lit(False).alias("outer"), "node", "comp", "set",
    )
    blocks = outer.unionByName(inner).groupBy("family", "row", "column")
    return blocks.applyInArrow(remote(_compared, percent), "a long, b long").distinct()


def _close(a: str, b: str, percent: int, most: int) -> Column:
    """Whether two members can be similar: by the bits in which their sketches differ, and by
    their sizes without `own`, the shingles that no other candidate has."""
    shared = F.least(F.expr(f"{a}.size - {a}.own"), F.expr(f"{b}.size - {b}.own"))
    enough = 100 * shared >= percent * (F.expr(f"{a}.size + {b}.size") - shared)
    return enough & (F.expr(f"bit_count({a}.sketch ^ {b}.sketch)") <= most)


def components(tables: Tables, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Labels (node, comp) after joining the components that links (a, b) connect.

    Each component takes the smallest label among itself and its neighbours, and the links
    move on to the new labels, until none is left; every step at least halves what is linked.
    """
    step = 0
    edges = links
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        moved = tables.write(
            f"{name}-moved{step}",
            least.where("b < a").select(F.col("a").alias("old"), F.col("b").alias("new")),
        )
        labels = tables.write(
            f"{name}-labels{step}",
            labels.join(moved, F.col("comp") == F.col("old"), "left")
            .select("node", F.coalesce("new", "comp").alias("comp")),
        )
        to_a = moved.select(F.col("old").alias("a"), F.col("new").alias("new_a"))
        to_b = moved.select(F.col("old").alias("b"), F.col("new").alias("new_b"))
        edges = tables.write(
            f"{name}-edges{step}",
            edges.join(to_a, "a", "left").join(to_b, "b", "left")
            .select(F.coalesce("new_a", "a").alias("a"), F.coalesce("new_b", "b").alias("b"))
            .where("a <> b")
            .distinct(),
        )
        step += 1
    return labels


def near_duplicates(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    r"""Components of the texts whose shingle sets have a similarity of `percent` or more.

    Words are `[^\x20\x09-\x0D]+` with A-Z in lower case; a set holds the distinct shingles of
    `words` words as 64-bit hashes, and two sets are linked if
    100 * intersection >= percent * union. Gives a row for each row of the table: the id,
    hash (of the text), n_shingles, component_id (smallest id reachable), kept
    (id = component_id) and first (true for the first of a component in the order of id and hash).

    1. Equal sets become one node. A signature has COMPONENTS values of 8 bits; a pair at
       the similarity is within the signature distance but for a chance of MISS.
    2. The signature is split into so many chunks that a pair within that distance agrees in one
       of them but for ERRORS components; each choice of these gives a key, and nodes that share
       a key meet.
    3. Nodes that meet no node of like size and sketch are alone. The others' sets are written,
       and the shingles that only one of them has are counted: they bound its similarity to any.
    4. In each round every member of a bucket is compared with one drawn member, unless they are
       connected already. Nodes that were compared form families, linked or not. The nodes
       outside a family's largest component are compared with the whole family, in blocks
       that give links alone; members of a bucket that are of different families are
       compared last. Every link is confirmed on the full sets, and no bucket gives all its pairs.

    A text without words, null or empty, has no set and is linked with nothing: its
    component_id is its id. With fewer words than a shingle has, the whole text is one. Null ids
    are never a component's smallest unless all are null; rows that repeat an id are told
    apart by their texts. Equal texts are always linked. An empty table stays empty. Other
    columns play no part.
    """
    spark = df.sparkSession
    tables = Tables(spark, "near")
    similarity = percent / 100
    most_bits = distance(64, (1 - similarity) / 2)
    source = df.select(
        column(id).alias("id"), F.xxhash64(column(text)).alias("hash"),
        column(text).cast("string").alias(TEXT),
    )
    plain = [source.schema["id"], source.schema["hash"]]
    signed_schema = T.StructType([
        *plain, T.StructField("digest", T.BinaryType()), T.StructField("size", T.LongType()),
        T.StructField("sign", T.BinaryType()), T.StructField("sketch", T.LongType()),
    ])
    signed = tables.write("signed", source.mapInArrow(remote(_signed, words), signed_schema))
    none = F.col("id").isNull()
    nodes = (
        signed.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min(F.struct(none.alias("none"), "id", "hash")).alias("first"),
            F.first("size").alias("size"), F.first("sign").alias("sign"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = tables.write("nodes", nodes)
    key_schema = T.StructType([
        T.StructField("node", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("sketch", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
    ])
    keyed = nodes.select("node", "size", "sketch", "sign").mapInArrow(
        remote(_keyed, similarity), key_schema
    )
    members = keyed.select("node", "size", "sketch", F.lit(0).alias("own"), F.explode("keys").alias("key"))
    x, y = members.alias("x"), members.alias("y")
    meets = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") != F.col("y.node"))
    meeting = tables.write(
        "meeting",
        x.join(y, meets & _close("x", "y", percent, most_bits), "left_semi")
        .select("node").distinct(),
    )
    texts = nodes.join(meeting, "node", "left_semi").select(
        "node", F.col("first.id").alias("first_id"), F.col("first.hash").alias("first_hash")
    )
    wanted = source.join(
        texts, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))
    ).dropDuplicates(["node"]).select("node", TEXT)
    sets = tables.write(
        "sets", wanted.mapInArrow(remote(_sets, words), "node long, set array<long>")
    )
    own = (
        sets.select("node", F.explode("set").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("times"))
        .where("times = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    alike = (
        keyed.join(meeting, "node", "left_semi")
        .join(own, "node", "left")
        .withColumn("own", F.coalesce("own", F.lit(0)))
        .where(100 * (F.col("size") - F.col("own")) >= percent * F.col("size"))
    )
    alike = tables.write("alike", alike)
    labels = tables.write("labels", alike.select("node", F.col("node").alias("comp")))
    families = labels
    for number in range(ROUNDS + 1):
        last = number == ROUNDS
        bucket = alike.join(labels, "node")
        if last:
            links = tables.write(
                "families", linked_in_families(tables, sets, labels, families, percent)
            )
            labels = components(tables, labels, links, "families")
            bucket = alike.join(labels, "node").join(
                families.withColumnRenamed("comp", "family"), "node"
            )
        bucket = bucket.select(
            "node", "comp", *["family"] * last, "size", "own", "sketch",
            F.explode("keys").alias("key"),
        )
        if not last:
            # few drawn nodes at first, as most will be linked to them; then others in each bucket
            salt = F.pmod("key", F.lit(4)) if number == 0 else F.col("key")
            draw = F.xxhash64("node", salt, F.lit(number))
            drawn = bucket.groupBy("key").agg(
                F.min(F.struct(draw, "node", "comp", "size", "own", "sketch")).alias("y")
            )
            x, y = bucket.alias("x"), drawn.select("key", "y.*").alias("y")
            apart = F.col("x.comp") != F.col("y.comp")
        else:
            x, y = bucket.alias("x"), bucket.alias("y")
            apart = (F.col("x.comp") < F.col("y.comp")) & (F.col("x.family") != F.col("y.family"))
        met = (F.col("x.key") == F.col("y.key")) & apart & _close("x", "y", percent, most_bits)
        pairs = (
            x.join(y, met)
            .select(
                F.least("x.node", "y.node").alias("left"),
                F.greatest("x.node", "y.node").alias("right"),
                F.least("x.comp", "y.comp").alias("a"), F.greatest("x.comp", "y.comp").alias("b"),
            )
            .distinct()
        )
        pairs = tables.write(f"pairs{number}", pairs)
        one = sets.select(F.col("node").alias("left"), F.col("set").alias("one"))
        two = sets.select(F.col("node").alias("right"), F.col("set").alias("two"))
        both = F.size(F.array_intersect("one", "two"))
        linked = (
            pairs.join(one, "left").join(two, "right")
            .where(100 * both >= percent * (F.size("one") + F.size("two") - both))
            .select("a", "b").distinct()
        )
        links = tables.write(f"links{number}", linked)
        labels = components(tables, labels, links, f"round{number}")
        if not last:
            met_nodes = pairs.select(F.col("left").alias("a"), F.col("right").alias("b")).join(
                families.select(F.col("node").alias("a"), F.col("comp").alias("fa")), "a"
            ).join(families.select(F.col("node").alias("b"), F.col("comp").alias("fb")), "b")
            joined = met_nodes.select(
                F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")
            ).where("a <> b").distinct()
            families = components(
                tables, families, tables.write(f"met{number}", joined), f"family{number}"
            )
    grouped = nodes.join(labels, "node", "left").select(
        "digest", F.coalesce("comp", "node").alias("comp"), "first"
    )
    grouped = tables.write("grouped", grouped)
    firsts = grouped.groupBy("comp").agg(F.min("first").alias("lead"))
    told = grouped.select("digest", "comp").join(firsts, "comp").select("digest", "lead")
    told = tables.write("told", told)
    tables.drop(*[n for n in tables.paths if n not in ("signed", "told")])
    own_rank = F.struct(none.alias("none"), "id", "hash")
    rows = signed.select("id", "hash", "digest", "size")
    alone = rows.where(F.col("digest").isNull()).select(
        "id", "hash", F.lit(0).cast("long").alias("size"), F.col("id").alias("component_id"),
        F.lit(True).alias("first"),
    )
    joined = rows.join(told, "digest").select(
        "id", "hash", "size", F.col("lead.id").alias("component_id"),
        (own_rank == F.col("lead")).alias("first"),
    )
    return joined.unionByName(alone).select(
        F.col("id").alias(id), "hash", F.col("size").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "first",
    )


def without_near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The table with one row of each component, the first in the order of id and text hash.

    Rows that repeat both id and text are one row; all texts without words stay, but for those.
    """
    first = near_duplicates(df, id, text, words, percent).where("first").select(
        F.col(id).alias("__llm_id"), F.col("hash").alias("__llm_hash")
    ).distinct()
    hash_ = F.xxhash64(column(text))
    same = column(id).eqNullSafe(F.col("__llm_id")) & (hash_ == F.col("__llm_hash"))
    joined = df.withColumn("__llm_own", hash_).join(first, same, "left_semi")
    return joined.dropDuplicates([id, "__llm_own"]).select(*[column(c) for c in df.columns])
