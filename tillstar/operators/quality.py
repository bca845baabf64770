"""Data-quality checks.

A check returns the offending rows; no rows means it passes. Row rules on one
table are counted together in a single scan. Nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.numbers import MONEY, ratio
from tillstar.operators.joins import orphans
from tillstar.operators.reshape import union_all

ERROR = "error"
WARN = "warn"

# Patterns that look like an injected command or script.
INJECTION_PATTERNS = [
    r"(?i)(SELECT|DROP|DELETE|INSERT|UPDATE|UNION|ALTER|CREATE|TRUNCATE|EXEC|EXECUTE)",
    r"(<script|javascript:|onload=|onerror=|xp_|sp_)",
    r"'",
    r'"',
    r";",
    r"<",
    r">",
    r"(--|/\*|\*/)",
]


@dataclass(frozen=True)
class RowRule:
    """A predicate that is true for a bad row."""

    table: str
    name: str
    bad: Column
    severity: str = ERROR
    tags: tuple[str, ...] = ()


@dataclass(frozen=True)
class Keys:
    """The keys of a table's rows that a check compares, as text; null where a row has none."""

    table: str
    key: Column


@dataclass(frozen=True)
class TableRule:
    """A check over whole tables; `offenders` gives one row per failure.

    `weight` names a column counting how many rows a failure stands for. A check that compares
    keys names them: of `keys` alone it counts those found more than once, with `parents` the rows
    whose key is not among those. Such checks are counted together, see `check_report`.
    """

    table: str
    name: str
    offenders: Callable[[Mapping[str, DataFrame]], DataFrame]
    severity: str = ERROR
    tags: tuple[str, ...] = ()
    weight: str | None = None
    needs: tuple[str, ...] = field(default=())
    keys: Keys | None = None
    parents: Keys | None = None


def _and_where(bad: Column, where: str | None) -> Column:
    return bad if where is None else bad & F.expr(where)


def not_null(table: str, *columns: str, where: str | None = None, **kw) -> list[RowRule]:
    return [
        RowRule(table, f"not_null_{c}", _and_where(F.col(c).isNull(), where), **kw)
        for c in columns
    ]


def accepted_values(
    table: str, column: str, values: Sequence[str], where: str | None = None, **kw
) -> RowRule:
    """Any other value is bad; null passes."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return RowRule(table, f"accepted_values_{column}", _and_where(bad, where), **kw)


def accepted_range(
    table: str,
    column: str,
    low: Column | int | str | None = None,
    high: Column | int | str | None = None,
    where: str | None = None,
    **kw,
) -> RowRule:
    """Values below `low` or above `high` are bad; bounds may be expressions, null passes."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return RowRule(table, f"accepted_range_{column}", _and_where(bad, where), **kw)


def numeric_range(
    table: str, column: str, low: int, high: int, where: str | None = None, **kw
) -> RowRule:
    """Whole-number reading of the column outside [low, high]; text that is no number passes."""
    number = F.col(column).try_cast("bigint")
    bad = (number < low) | (number > high)
    return RowRule(table, f"numeric_range_{column}", _and_where(bad, where), **kw)


def text_pattern(
    table: str, column: str, pattern: str, where: str | None = None, **kw
) -> RowRule:
    """Text that is filled but does not contain a match of the pattern."""
    text = F.col(column)
    bad = text.isNotNull() & (F.trim(text) != "") & ~text.rlike(pattern)
    return RowRule(table, f"text_pattern_{column}", _and_where(bad, where), **kw)


def injection_scan(table: str, column: str, where: str | None = None, **kw) -> RowRule:
    """Text holding anything that looks like an injected command or script."""
    text = F.col(column)
    hits = [text.rlike(p) for p in INJECTION_PATTERNS]
    bad = text.isNotNull() & (F.trim(text) != "") & reduce(lambda a, b: a | b, hits)
    return RowRule(table, f"injection_scan_{column}", _and_where(bad, where), **kw)


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Key values found more than once."""
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def unique(table: str, column: str, **kw) -> TableRule:
    """Non-null values found more than once."""
    return TableRule(
        table, f"unique_{column}",
        lambda frames: duplicates(frames[table].where(F.col(column).isNotNull()), column),
        needs=(table,), keys=Keys(table, F.col(column).cast("string")), **kw,
    )


def unique_combination(table: str, *columns: str, **kw) -> TableRule:
    """Column combinations found more than once; null counts as a value."""
    return TableRule(
        table, f"unique_combination_{'_'.join(columns)}",
        lambda frames: duplicates(frames[table], *columns), needs=(table,),
        # a null is left out of the text, so it equals itself alone
        keys=Keys(table, F.to_json(F.struct(*columns))), **kw,
    )


def relationship(
    table: str, column: str, parent: str, parent_column: str, where: str | None = None, **kw
) -> TableRule:
    """Non-null child keys without a parent row."""
    key = F.col(column).cast("string")

    def find(frames: Mapping[str, DataFrame]) -> DataFrame:
        child = frames[table] if where is None else frames[table].where(where)
        return orphans(child, column, frames[parent], parent_column)

    return TableRule(
        table, f"relationship_{column}_to_{parent}_{parent_column}", find, weight="child_rows",
        needs=(table, parent),
        keys=Keys(table, key if where is None else F.when(F.expr(where), key)),
        parents=Keys(parent, F.col(parent_column).cast("string")), **kw,
    )


Rule = RowRule | TableRule


def violations(frames: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """The offending rows of one rule, all of them."""
    if isinstance(rule, RowRule):
        return frames[rule.table].where(rule.bad)
    return rule.offenders(frames)


def _counted_together(
    frames: Mapping[str, DataFrame], rules: Sequence[RowRule | TableRule]
) -> DataFrame:
    """Violations of rules on rows and keys, from one scan of each table and one shuffle.

    Every row gives an entry for each rule that it breaks and each key that a rule compares:
    the rule, the key and the side it stands on. Entries are counted by rule and key, first
    where the row is, so a common key crosses the shuffle once a task.
    """
    entries: dict[str, list[Column]] = {}

    def entry(table: str, when: Column, rule: int, key: Column, parent: bool) -> None:
        row = F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.lit(parent).alias("parent"))
        entries.setdefault(table, []).append(F.when(when, row))

    for number, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            entry(rule.table, rule.bad, number, F.lit(""), False)
            continue
        for side, parent in ((rule.keys, False), (rule.parents, True)):
            if side is not None:
                entry(side.table, side.key.isNotNull(), number, side.key, parent)
    tagged = [
        frames[table].select(F.explode(F.array_compact(F.array(*own))).alias("e")).select("e.*")
        for table, own in entries.items()
    ]
    by_key = union_all(tagged).groupBy("rule", "key").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.max("parent").alias("known")
    )
    # every rule has a row, also without an entry
    every = SparkSession.active().range(len(rules)).select(
        F.col("id").cast("int").alias("rule"), F.lit("").alias("key"),
        F.lit(0).cast("bigint").alias("rows"), F.lit(True).alias("known"),
    )
    kinds = F.array(*[
        F.lit("row" if isinstance(r, RowRule) else "key" if r.parents is None else "child")
        for r in rules
    ])
    kind = kinds[F.col("rule")]
    broken = (
        F.when(kind == "row", F.col("rows"))
        .when(kind == "key", (F.col("rows") > 1).cast("bigint"))
        .when(~F.col("known"), F.col("rows"))
        .otherwise(0)
    )
    counts = by_key.unionByName(every).groupBy("rule").agg(F.sum(broken).alias("violations"))

    def of(texts) -> Column:
        return F.array(*[F.lit(t) for t in texts])[F.col("rule")]

    return counts.select(
        of(r.table for r in rules).alias("table_name"),
        of(r.name for r in rules).alias("check_name"),
        of(r.severity for r in rules).alias("severity"),
        of(",".join(r.tags) for r in rules).alias("tags"),
        "violations",
    )


def _table_rule_count(frames: Mapping[str, DataFrame], rule: TableRule) -> DataFrame:
    found = rule.offenders(frames)
    total = F.count("*") if rule.weight is None else F.coalesce(F.sum(rule.weight), F.lit(0))
    return found.agg(total.cast("bigint").alias("violations")).select(
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.name).alias("check_name"),
        F.lit(rule.severity).alias("severity"),
        F.lit(",".join(rule.tags)).alias("tags"),
        "violations",
    )


def check_report(
    frames: Mapping[str, DataFrame],
    rules: Sequence[Rule],
    tags: Sequence[str] | None = None,
) -> DataFrame:
    """One row per rule: table, check, severity, tags, violations and status.

    All rules on rows and keys are counted in one pass over each table; a table rule of its own
    kind is counted alone. `tags` keeps only the rules that carry one of them.
    """
    if tags is not None:
        rules = [r for r in rules if set(tags) & set(r.tags)]
    together = [r for r in rules if isinstance(r, RowRule) or r.keys is not None]
    parts = [_counted_together(frames, together)] if together else []
    parts += [
        _table_rule_count(frames, r) for r in rules if isinstance(r, TableRule) and r.keys is None
    ]
    status = F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity"))
    return union_all(parts).withColumn("status", status)


def freshness(
    df: DataFrame, moment: str, now: Column, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row and whether it is still fresh."""
    age = F.timestamp_diff("SECOND", F.col("newest"), now) / 3600
    return df.agg(F.max(moment).cast("timestamp").alias("newest")).select(
        "newest",
        age.alias("age_hours"),
        F.when(F.col("newest").isNull() | (age > error_hours), ERROR)
        .when(age > warn_hours, WARN)
        .otherwise("pass")
        .alias("status"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, filled rows and distinct values of several columns, a row for each column.

    Every row gives its value of each column, counted by column and value where the row is; so
    a common value crosses the shuffle once a task, and no row is carried once for each column.
    """
    kinds = dict(df.dtypes)

    def text(name: str) -> Column:
        # one zero
        value = F.col(name) + 0.0 if kinds[name] in ("double", "float") else F.col(name)
        return value.cast("string")

    cells = [F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns]
    counted = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.column_name", "cell.value")
        .agg(F.count("*").alias("n"))
    )
    # every column has a row, also of an empty table
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name")
    every = df.sparkSession.range(1).select(
        names, F.lit(None).cast("string").alias("value"), F.lit(0).cast("bigint").alias("n")
    )
    return counted.unionByName(every).groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
        F.count("value").alias("unique"),
    )


def null_profile(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rows, nulls and distinct values of several columns."""
    listed = value_counts(df, columns)
    empty = F.col("total") - F.col("filled")
    return listed.select(
        F.lit(label).alias("table_name"),
        "column_name",
        F.col("total").alias("total_records"),
        F.col("filled").alias("non_null_records"),
        empty.alias("null_records"),
        F.round(ratio(empty * 100, F.col("total")), 2).alias("null_percentage"),
        F.col("unique").alias("unique_values"),
    )


def compare_nulls(
    source: DataFrame, staged: DataFrame, columns: Sequence[str], where: str | None = None
) -> DataFrame:
    """Null profile of columns in a source and its staged form, and the difference."""
    if where is not None:
        source, staged = source.where(where), staged.where(where)
    kept = ["column_name", "total_records", "null_records", "null_percentage", "unique_values"]

    def side(df: DataFrame, name: str) -> DataFrame:
        profile = null_profile(df, columns, name).select(*kept)
        return profile.withColumnsRenamed({c: f"{name}_{c}" for c in kept[1:]})

    both = side(source, "source").join(side(staged, "staged"), "column_name")
    gap = F.col("staged_null_records") - F.col("source_null_records")
    verdict = F.when(gap > 0, "more nulls").when(gap < 0, "fewer nulls").otherwise("equal")
    return both.withColumn("null_difference", gap).withColumn("verdict", verdict)


def profile(
    df: DataFrame,
    user: str = "customer_id",
    key: str = "transaction_id",
    day: str = "date",
    amount: str = "transaction_total",
    today: Column | None = None,
) -> DataFrame:
    """Table profile in one row, with the number of kinds of issue found."""
    today = F.current_date() if today is None else today
    money = F.col(amount).cast(MONEY)
    one = df.agg(
        F.count("*").alias("total_records"),
        F.min(day).alias("earliest_day"),
        F.max(day).alias("latest_day"),
        F.sum(money).cast("double").alias("total_amount"),
        ratio(F.sum(money), F.count(amount)).alias("avg_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        (F.count("*") - F.count(user)).alias("null_users"),
        (F.count("*") - F.count(key)).alias("null_keys"),
        (F.count("*") - F.count(amount)).alias("null_amounts"),
        F.count_if(F.col(amount) <= 0).alias("non_positive_amounts"),
        F.count_if(F.col(day) > today).alias("future_days"),
    )
    issues = ["null_users", "null_keys", "null_amounts", "non_positive_amounts", "future_days"]
    distinct = {user: "unique_users", key: "unique_keys", day: "distinct_days"}
    found = value_counts(df, list(distinct)).agg(*[
        F.max(F.when(F.col("column_name") == c, F.col("unique"))).alias(n)
        for c, n in distinct.items()
    ])
    # two rows, each with nulls for what the other one has
    both = one.unionByName(found, allowMissingColumns=True)
    order = [
        "total_records", "unique_users", "unique_keys", "earliest_day", "latest_day",
        "distinct_days", *[c for c in one.columns if c not in ("total_records", "earliest_day", "latest_day")],
    ]
    merged = both.agg(*[F.max(c).alias(c) for c in order])
    kinds = reduce(lambda a, b: a + b, [(F.col(c) > 0).cast("int") for c in issues])
    return merged.withColumn("issue_kinds", kinds)


def expected_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each expected or actual column with `ok`, `missing` or `extra`."""
    actual = df.columns
    rows = [(n, "ok" if n in actual else "missing") for n in names]
    rows += [(n, "extra") for n in actual if n not in names]
    return df.sparkSession.createDataFrame(rows, "column_name string, status string")


def schema_drift(
    spark: SparkSession,
    actual: Mapping[str, T.StructType],
    declared: Mapping[str, Mapping[str, str | None]],
) -> DataFrame:
    """Actual columns against declared types.

    `declared` maps table to column to type name; a column may be declared
    without a type. Only schemas are read, never rows.
    """

    def verdict(table: str, name: str, kind: str) -> str:
        if table not in declared:
            return "table_missing"
        if name not in declared[table]:
            return "column_missing"
        wanted = declared[table][name]
        if not wanted:
            return "no_dt"
        return "all_okay" if wanted == kind else "wrong_dt"

    rows = [
        (table, f.name, f.dataType.simpleString(), verdict(table, f.name, f.dataType.simpleString()))
        for table, schema in actual.items()
        for f in schema.fields
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, test_result string"
    )


def relationship_counts(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Rows, keys and nulls of parent and child, and child rows without a parent."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"total_{name}_records"),
            F.countDistinct(F.col(key).cast("string")).alias(f"unique_{name}_keys"),
            (F.count("*") - F.count(key)).alias(f"null_{name}_keys"),
        )

    lost = orphans(child, key, parent, key).agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphaned_records")
    )
    # Three single-row frames side by side: each column is filled in one of them.
    stacked = side(parent, "parent")
    for one in (side(child, "child"), lost):
        stacked = stacked.unionByName(one, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in frames.items()
        ]
    )


def missing_activity_types(activity: DataFrame) -> DataFrame:
    """One row when fewer than two kinds of activity are present."""
    return activity.agg(F.countDistinct("activity_type").alias("n_types")).where(
        F.col("n_types") < 2
    )


def scd_integrity(dim: DataFrame, key: str, table: str) -> DataFrame:
    """Keys breaking a versioning rule: more than one current version, a current
    version with an end, or a past version without one. One aggregate per key."""
    per_key = dim.groupBy(F.col(key).cast("string").alias("natural_key")).agg(
        F.count_if("is_current").alias("current_rows"),
        F.count_if(F.col("is_current") & F.col("valid_to").isNotNull()).alias("current_ended"),
        F.count_if(~F.col("is_current") & F.col("valid_to").isNull()).alias("history_open"),
    )
    tests = F.stack(
        F.lit(3),
        F.lit("current_record_uniqueness"),
        F.when(F.col("current_rows") > 1, F.col("current_rows")).otherwise(0),
        F.lit("current_valid_to_null"), F.col("current_ended"),
        F.lit("historical_valid_to_not_null"), F.col("history_open"),
    ).alias("test_name", "bad_rows")
    return (
        per_key.select("natural_key", tests)
        .where(F.col("bad_rows") > 0)
        .select(F.lit(table).alias("table_name"), "test_name", "natural_key", "bad_rows")
    )


def scd_timeline(dim: DataFrame, key: str) -> DataFrame:
    """Keys without or with several current versions, and versions whose start is
    not the end of the one before or whose end contradicts `is_current`."""
    per_key = dim.groupBy(F.col(key).cast("string").alias("natural_key")).agg(
        F.count_if("is_current").alias("n")
    )
    current_issue = per_key.where(F.col("n") != 1).select(
        "natural_key",
        F.when(F.col("n") == 0, "NO_CURRENT_RECORD")
        .otherwise("MULTIPLE_CURRENT_RECORDS")
        .alias("issue_type"),
        F.col("n").alias("issue_count"),
    )
    ended = F.lag("valid_to").over(Window.partitionBy(key).orderBy("valid_from"))
    is_current, valid_to = F.col("is_current"), F.col("valid_to")
    issue = (
        F.when(F.col("ended") != F.col("valid_from"), "TEMPORAL_GAP_OR_OVERLAP")
        .when(is_current & valid_to.isNotNull(), "CURRENT_RECORD_HAS_END_DATE")
        .when(~is_current & valid_to.isNull(), "HISTORICAL_RECORD_MISSING_END_DATE")
    )
    versions = dim.withColumn("ended", ended).select(
        F.col(key).cast("string").alias("natural_key"),
        issue.alias("issue_type"),
        F.lit(1).cast("bigint").alias("issue_count"),
    )
    return current_issue.unionByName(versions.where(F.col("issue_type").isNotNull()))


def activity_timeline(activity: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Purchases outside the version they carry, and customers whose last sequence
    number is not their number of activities."""
    versions = dim_users.select(
        F.col("user_key").alias("customer_version_key"), "valid_from", "valid_to"
    )
    bought = activity.where(
        (F.col("activity_type") == "transaction") & F.col("customer_id").isNotNull()
    ).select("customer_id", "activity_date", "customer_version_key")
    joined = bought.join(versions, "customer_version_key", "left")
    day = F.col("activity_date")
    inside = (day >= F.col("valid_from").cast("date")) & (
        F.col("valid_to").isNull() | (day < F.col("valid_to").cast("date"))
    )
    outside = joined.where(~inside).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        day.cast("string").alias("activity_date"),
        F.col("customer_version_key").cast("string").alias("customer_version_key"),
        F.lit("INVALID_SCD_JOIN").alias("failure_reason"),
    )
    broken = (
        activity.groupBy("customer_id")
        .agg(F.count("*").alias("n"), F.max("customer_activity_sequence").alias("last"))
        .where((F.col("n") > 1) & (F.col("last") != F.col("n")))
        .select(
            F.col("customer_id").cast("string").alias("customer_id"),
            F.lit("N/A").alias("activity_date"),
            F.lit("N/A").alias("customer_version_key"),
            F.lit("INVALID_CUSTOMER_SEQUENCE").alias("failure_reason"),
        )
    )
    return outside.unionByName(broken)
