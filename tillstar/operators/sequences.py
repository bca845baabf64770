"""Ordering of a key's events when one key may own much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.scd import slot_of

#: Stands for a missing day: the first that there is.
FIRST_DAY = "0001-01-01"


def group_marks(ties: Sequence[str]) -> dict[str, Column]:
    """Text in place of the ties that groups are made of, as null equals itself only in a null-safe
    join, after which a window would need another shuffle."""
    return {f"__{t}": F.coalesce(F.col(t).cast("string"), F.lit("\0")) for t in ties[:-1]}


def sequence_events(
    df: DataFrame, key: str, day: str, ties: Sequence[str], months: int | None = None
) -> DataFrame:
    """Add `sequence`, `prev_day` and `first_day` to each event of a key, by day then `ties`.

    A window over the whole key would put a hot key's events in one task. Events
    are numbered within key, day and all ties but the last; the sizes of these groups are
    summed over the day, those of days over the key, and joined back. So a busy
    day spreads over its groups, and no window holds more than the groups of a day or
    the days of a key. The events are read twice and should be a stored table.
    Rows without key or day are left out.

    With `months` the groups are summed over stretches of so many months instead of days, and
    the stretches over the key, which moves less where a day has few events: a window holds the
    groups of a stretch, or the stretches of a key. Events stored by key, day and `group_marks`,
    which they bring along, aren't shuffled themselves.
    """
    early = ties[:-1]
    marks = group_marks(ties)
    group = [key, day, *marks]
    marked = df.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    if not set(marks) <= set(df.columns):
        marked = marked.withColumns(marks)
    if months is not None and early:
        return _numbered(df, marked, _known_by_stretch(marked, key, day, early, months), group, day, ties)
    parts = marked.groupBy(*group).agg(
        F.count("*").alias("__n"), *[F.first(t).alias(f"{t}__value") for t in early]
    )
    within = Window.partitionBy(key, day).orderBy(*[f"{t}__value" for t in early])
    if early:
        within = within.rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    else:
        parts = parts.withColumn("__before", F.lit(0))
    across = Window.partitionBy(key).orderBy(day)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    # counted from the events, where they are: the groups of a day may be as many as its events,
    # so that their sums would be a shuffle by group more
    days = (
        marked.groupBy(key, day)
        .agg(F.count("*").alias("__n"))
        .select(
            key, day,
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
            F.lag(day).over(across).alias("__last_day"),
            F.first(day).over(across).alias("first_day"),
        )
    )
    if early:
        opening = F.when(F.col("__before") == 0, F.col("__last_day")).otherwise(F.col(day))
        known = parts.join(days, [key, day]).select(
            *group, opening.alias("__last_day"), "first_day",
            (F.col("__offset") + F.col("__before")).alias("__offset"),
        )
    else:
        known = days.select(key, day, "__last_day", "first_day", "__offset")
    return _numbered(df, marked, known, group, day, ties)


def _known_by_stretch(
    marked: DataFrame, key: str, day: str, early: Sequence[str], months: int
) -> DataFrame:
    """Offset, day before and first day of the key for each group, by stretches of `months`."""
    names = [f"{t}__value" for t in early]
    parts = (
        marked.groupBy(key, day, *[f"__{t}" for t in early])
        .agg(F.count("*").alias("__n"), *[F.first(t).alias(n) for t, n in zip(early, names)])
        .select(key, day, slot_of(F.col(day), months).alias("__stretch"), "__n", *names)
        # said here, so that both readers below want the same rows and share one shuffle
        .where(F.col("__stretch").isNotNull())
    )
    within = Window.partitionBy(key, "__stretch").orderBy(day, *names)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    sized = parts.withColumns({
        "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
        "__last_day": F.lag(day).over(within),
        "__opened": F.first(day).over(within),
        "__last": F.lead(day).over(within).isNull(),
    })
    # the last group of a stretch tells its size, first and last day
    across = Window.partitionBy("__key").orderBy("__of")
    stretches = sized.where("__last").select(
        F.col(key).alias("__key"), F.col("__stretch").alias("__of"),
        (F.col("__before") + F.col("__n")).alias("__size"), F.col(day).alias("__closed"), "__opened",
    )
    offsets = stretches.select(
        "__key", "__of",
        F.coalesce(
            F.sum("__size").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__offset"),
        F.lag("__closed").over(across).alias("__day_before"),
        F.first("__opened").over(across).alias("first_day"),
    )
    same = (F.col(key) == F.col("__key")) & (F.col("__stretch") == F.col("__of"))
    return sized.drop("__opened").join(offsets, same).select(
        key, day,
        *[F.coalesce(F.col(n).cast("string"), F.lit("\0")).alias(f"__{t}") for t, n in zip(early, names)],
        F.coalesce("__last_day", "__day_before").alias("__last_day"), "first_day",
        (F.col("__offset") + F.col("__before")).alias("__offset"),
    )


def _numbered(
    df: DataFrame, marked: DataFrame, known: DataFrame, group: Sequence[str], day: str, ties: Sequence[str]
) -> DataFrame:
    inside = Window.partitionBy(*group).orderBy(ties[-1])
    opens = F.col("__place") == 1
    return (
        marked.join(known, group)
        .withColumn("__place", F.row_number().over(inside))
        .select(
            *df.columns, "first_day",
            (F.col("__place") + F.col("__offset")).cast("bigint").alias("sequence"),
            F.when(opens, F.col("__last_day")).otherwise(F.col(day)).alias("prev_day"),
        )
    )


def running_counts(df: DataFrame, key: str, day: str, name: str) -> DataFrame:
    """Add to each row the number of the key's rows up to and on its day.

    Rows are counted by key and day where they are; the running sum holds one row per key and
    day, and its result is joined back on both, so a key that owns much of the data is spread over
    its days, and a day of it by Spark's skew join. Rows without a key are left out; those
    without a day count as before all days.
    """
    rows = df.where(F.col(key).isNotNull()).withColumn(
        "__on", F.coalesce(F.col(day).cast("date"), F.lit(FIRST_DAY).cast("date"))
    )
    upto = Window.partitionBy("__key").orderBy("__day")
    sums = (
        rows.groupBy(F.col(key).alias("__key"), F.col("__on").alias("__day"))
        .agg(F.count("*").alias("__n"))
        .select("__key", "__day", F.sum("__n").over(upto).alias(name))
    )
    same = (F.col(key) == F.col("__key")) & (F.col("__on") == F.col("__day"))
    return rows.join(sums, same).drop("__key", "__day", "__on")


def running_totals(
    marks: DataFrame,
    amounts: DataFrame,
    key: str,
    day: str,
    totals: Sequence[str],
) -> DataFrame:
    """Add to each (key, day) mark the sum of the key's amounts up to and on that day.

    Both sides hold one row per key and day, so a key's window is bounded by days.
    """
    zero = [F.lit(None).cast("decimal(38,6)").alias(f"__{t}") for t in totals]
    tagged = marks.select("*", *zero, F.lit(1).alias("__mark"))
    blank = [
        F.col(c) if c in (key, day) else F.lit(None).cast(marks.schema[c].dataType).alias(c)
        for c in marks.columns
    ]
    fed = amounts.select(
        *blank,
        *[F.col(t).cast("decimal(38,6)").alias(f"__{t}") for t in totals],
        F.lit(0).alias("__mark"),
    )
    upto = (
        Window.partitionBy(key)
        .orderBy(day, "__mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    both = tagged.unionByName(fed)
    summed = both.select(
        *marks.columns, "__mark", *[F.sum(f"__{t}").over(upto).alias(t) for t in totals]
    )
    return summed.where(F.col("__mark") == 1).drop("__mark")
