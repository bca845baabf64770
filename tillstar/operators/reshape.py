"""Wide-to-long, unit explosion and union helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.keys import conformed_key, key_text


def unpivot_metrics(
    df: DataFrame,
    ids: Sequence[str],
    groups: Sequence[str],
    metrics: Mapping[str, str],
    name: str,
) -> DataFrame:
    """Columns `<group>_<metric>` to one row per group, in a single scan.

    `metrics` maps metric name to the type it is cast to.
    """
    cells = []
    for group in groups:
        cells.append(F.lit(group))
        cells += [F.col(f"{group}_{m}").cast(kind) for m, kind in metrics.items()]
    return df.select(*ids, F.stack(F.lit(len(groups)), *cells).alias(name, *metrics))


def any_positive(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) > 0 for c in columns])


#: Units of a line that are made in one go, and lines beyond it in blocks of as many.
BLOCK = 100_000


def explode_units(
    df: DataFrame, quantity: str, key_name: str, key_from: Sequence[str], block: int = BLOCK
) -> DataFrame:
    """One row per unit of a line, each with its own key; lines without units vanish.

    The units of a line are made where it is, so the blow-up needs no shuffle. A line of more than
    `block` units is first cut into blocks, which are dealt out over the tasks.
    """
    many = F.col(quantity).cast("bigint")
    size = F.lit(block).cast("bigint")
    plain = df.where((many > 0) & (many <= size)).select(
        "*", F.lit(0).cast("bigint").alias("__first"), many.alias("__last")
    )
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{quantity}` - 1) div {block}"))
    cut = (
        df.where(many > size)
        .select("*", F.explode(blocks).alias("__block"))
        .repartition(*key_from, "__block")
        .select(
            *df.columns, (F.col("__block") * size).alias("__first"),
            F.least((F.col("__block") + 1) * size, many).alias("__last"),
        )
    )
    units = F.sequence(F.col("__first") + 1, F.col("__last"))
    return (
        plain.unionByName(cut)
        .withColumn("__line", key_text(*key_from))  # once a line, not for each of its units
        .withColumn("unit_no", F.explode(units))
        .withColumn(quantity, F.lit(1).cast("bigint"))
        .withColumn(key_name, conformed_key("__line", "unit_no"))
        .drop("__first", "__last", "__line")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, never by position."""
    return reduce(lambda a, b: a.unionByName(b), frames)
