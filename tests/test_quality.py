"""Each check once on sound and once on broken rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail import sources
from tillstar.operators import quality as q
from tillstar.plans import checks
from tillstar.sources.schemas import SOURCES

D = dt.date


@pytest.fixture(scope="module")
def frames(spark):
    rows = [
        (1, "a", 5, "red hat", D(2024, 1, 1)),
        (2, "b", 50, "blue", D(2019, 1, 1)),
        (2, None, None, " ", None),
        (None, "z", 7, "DROP table", D(2024, 1, 1)),
        (None, "z", -1, "it's", D(2030, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "id bigint, kind string, n bigint, text string, day date")
    parent = spark.createDataFrame([("a",), ("b",)], "kind string")
    return {"t": df, "p": parent}


def bad(frames, rule):
    return q.violations(frames, rule).count()


def test_row_rules(frames):
    assert bad(frames, q.not_null("t", "id")[0]) == 2
    assert bad(frames, q.not_null("t", "id", where="kind is null")[0]) == 0
    assert bad(frames, q.accepted_values("t", "kind", ["a", "b"])) == 2
    assert bad(frames, q.accepted_values("t", "kind", ["a", "b", "z"])) == 0
    assert bad(frames, q.accepted_range("t", "n", 0, 10)) == 2
    assert bad(frames, q.accepted_range("t", "n", -1)) == 0
    assert bad(frames, q.accepted_range("t", "day", F.lit(D(2020, 1, 1)), F.lit(D(2025, 1, 1)))) == 2
    assert bad(frames, q.numeric_range("t", "n", 0, 10)) == 2
    assert bad(frames, q.numeric_range("t", "n", 0, 10, where="id = 2")) == 1
    assert bad(frames, q.numeric_range("t", "kind", 0, 10)) == 0
    assert bad(frames, q.text_pattern("t", "text", "^[a-z ]+$")) == 2
    assert bad(frames, q.injection_scan("t", "text")) == 2
    assert bad(frames, q.injection_scan("t", "kind")) == 0


@pytest.mark.parametrize(
    "text, hit",
    [
        ("plain text", False), ("updated", True), ("a;b", True), ("say \"x\"", True),
        ("<b", True), ("b>", True), ("a--b", True), ("/* x", True), ("xp_cmd", True),
        ("JavaScript:", False), ("javascript:", True), ("a-b", False),
    ],
)
def test_injection_patterns(spark, text, hit):
    df = spark.createDataFrame([(text,)], "text string")
    assert bad({"t": df}, q.injection_scan("t", "text")) == int(hit)


def test_table_rules(frames):
    assert bad(frames, q.unique("t", "id")) == 1
    assert bad(frames, q.unique("p", "kind")) == 0
    assert bad(frames, q.unique_combination("t", "id", "kind")) == 1
    assert bad(frames, q.unique_combination("t", "id", "n")) == 0
    orphans = q.violations(frames, q.relationship("t", "kind", "p", "kind")).collect()
    assert [tuple(r) for r in orphans] == [("z", 2)]
    assert bad(frames, q.relationship("t", "kind", "p", "kind", where="id is not null")) == 0


def test_report_counts_rows_and_sets_status(frames):
    rules = [
        *q.not_null("t", "id", tags=("critical",)),
        q.accepted_range("t", "n", -5, severity=q.WARN),
        q.accepted_range("t", "n", 0, severity=q.WARN, tags=("critical",)),
        q.relationship("t", "kind", "p", "kind"),
    ]
    report = q.check_report(frames, rules).collect()
    assert sorted((r.check_name, r.violations, r.status) for r in report) == [
        ("accepted_range_n", 0, "pass"), ("accepted_range_n", 1, "warn"),
        ("not_null_id", 2, "error"), ("relationship_kind_to_p_kind", 2, "error"),
    ]
    assert q.check_report(frames, rules, ["critical"]).count() == 2


def test_rules_are_counted_in_one_pass(spark, frames, tmp_path):
    stored = {}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    rules = [
        *q.not_null("t", "id", "kind", where="n > 0"), q.accepted_range("t", "n", 0, 10),
        q.unique("t", "id"), q.unique("t", "kind"), q.unique("p", "kind"),
        q.unique_combination("t", "id", "kind"), q.unique_combination("t", "kind"),
        q.relationship("t", "kind", "p", "kind"), q.relationship("p", "kind", "t", "kind"),
        q.relationship("t", "kind", "p", "kind", where="id is not null"),
        q.relationship("t", "n", "t", "id"),
    ]
    report = q.check_report(stored, rules)
    got = sorted((r.table_name, r.check_name, r.violations) for r in report.collect())

    def alone(rule):
        found = q.violations(frames, rule)
        weight = getattr(rule, "weight", None)
        return sum(r[weight] for r in found.collect()) if weight else found.count()

    assert got == sorted((r.table, r.name, alone(r)) for r in rules)
    assert sum(n for *_, n in got) > 10
    plan = str(report._jdf.queryExecution().executedPlan()).split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") == 2
    assert q.check_report({k: v.limit(0) for k, v in frames.items()}, rules).agg(
        F.sum("violations")
    ).first()[0] == 0


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "at timestamp_ntz")

    def status(hours):
        now = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)).cast("timestamp")
        return q.freshness(df, "at", now).first().status

    assert [status(h) for h in (24, 25, 48, 49)] == ["pass", "warn", "warn", "error"]
    empty = df.where("at is null")
    assert q.freshness(empty, "at", F.current_timestamp()).first().status == "error"


def test_null_comparison(spark):
    src = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "k string, v string")
    out = src.select(F.col("k").try_cast("bigint").alias("k"), "v")
    rows = {r.column_name: r for r in q.compare_nulls(src, out, ["k", "v"]).collect()}
    assert (rows["k"].null_difference, rows["k"].verdict) == (1, "more nulls")
    assert (rows["v"].null_difference, rows["v"].verdict) == (0, "equal")
    assert rows["k"].staged_null_percentage == 66.67


def test_profile(spark):
    rows = [("t1", 1, D(2024, 1, 1), 5.0), ("t2", None, D(2024, 1, 2), 0.0), (None, 1, D(2031, 1, 1), None)]
    df = spark.createDataFrame(
        rows, "transaction_id string, customer_id bigint, date date, transaction_total double"
    )
    r = q.profile(df, today=F.lit(D(2024, 6, 1))).first()
    assert (r.total_records, r.unique_users, r.unique_keys, r.distinct_days) == (3, 1, 2, 3)
    assert (r.total_amount, r.avg_amount, r.issue_kinds) == (5.0, 2.5, 5)
    clean = q.profile(df.where("transaction_id = 't1'"), today=F.lit(D(2024, 6, 1))).first()
    assert clean.issue_kinds == 0


def test_columns_and_drift(spark):
    df = spark.createDataFrame([(1, "a")], "a bigint, c string")
    got = {r.column_name: r.status for r in q.expected_columns(df, ["a", "b"]).collect()}
    assert got == {"a": "ok", "b": "missing", "c": "extra"}
    actual = {"t": df.schema, "u": df.schema}
    declared = {"t": {"a": "string", "c": "string"}}
    rows = {
        (r.table_name, r.column_name): r.test_result
        for r in q.schema_drift(spark, actual, declared).collect()
    }
    assert rows == {
        ("t", "a"): "wrong_dt", ("t", "c"): "all_okay", ("u", "a"): "table_missing",
        ("u", "c"): "table_missing",
    }
    declared = {"t": {"a": None}, "u": {"a": "bigint", "c": "string"}}
    rows = {
        (r.table_name, r.column_name): r.test_result
        for r in q.schema_drift(spark, actual, declared).collect()
    }
    assert rows[("t", "a")] == "no_dt" and rows[("t", "c")] == "column_missing"


def test_relationship_and_row_counts(spark):
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    assert tuple(q.relationship_counts(parent, child, "k").first()) == (3, 2, 1, 4, 2, 1, 2)
    counts = {r.table_name: r.row_count for r in q.row_counts({"p": parent, "c": child}).collect()}
    assert counts == {"p": 3, "c": 4}


def test_activity_types(spark):
    both = spark.createDataFrame([("transaction",), ("profile_change",)], "activity_type string")
    assert q.missing_activity_types(both).count() == 0
    assert q.missing_activity_types(both.limit(1)).count() == 1


def test_scd_checks(spark):
    schema = "k bigint, valid_from date, valid_to date, is_current boolean"
    good = spark.createDataFrame(
        [(1, D(2024, 1, 1), D(2024, 2, 1), False), (1, D(2024, 2, 1), None, True)], schema
    )
    assert q.scd_integrity(good, "k", "t").count() == q.scd_timeline(good, "k").count() == 0
    broken = spark.createDataFrame(
        [
            (1, D(2024, 1, 1), D(2024, 2, 1), True), (1, D(2024, 2, 5), None, True),
            (2, D(2024, 1, 1), None, False),
        ],
        schema,
    )
    integrity = {(r.natural_key, r.test_name) for r in q.scd_integrity(broken, "k", "t").collect()}
    assert integrity == {
        ("1", "current_record_uniqueness"), ("1", "current_valid_to_null"),
        ("2", "historical_valid_to_not_null"),
    }
    issues = {(r.natural_key, r.issue_type) for r in q.scd_timeline(broken, "k").collect()}
    assert issues == {
        ("1", "MULTIPLE_CURRENT_RECORDS"), ("1", "TEMPORAL_GAP_OR_OVERLAP"),
        ("1", "CURRENT_RECORD_HAS_END_DATE"), ("2", "NO_CURRENT_RECORD"),
        ("2", "HISTORICAL_RECORD_MISSING_END_DATE"),
    }


def test_activity_timeline(spark):
    versions = spark.createDataFrame(
        [(11, D(2024, 1, 1), D(2024, 2, 1))], "user_key bigint, valid_from date, valid_to date"
    )
    schema = (
        "customer_id bigint, activity_type string, activity_date date, "
        "customer_version_key bigint, customer_activity_sequence bigint"
    )
    good = [(1, "transaction", D(2024, 1, 5), 11, 1), (1, "transaction", D(2024, 1, 6), 11, 2)]
    assert q.activity_timeline(spark.createDataFrame(good, schema), versions).count() == 0
    wrong = [(1, "transaction", D(2024, 2, 1), 11, 1), (1, "transaction", D(2024, 1, 6), 11, 1)]
    got = q.activity_timeline(spark.createDataFrame(wrong, schema), versions).collect()
    assert sorted(r.failure_reason for r in got) == ["INVALID_CUSTOMER_SEQUENCE", "INVALID_SCD_JOIN"]


def test_source_rules_and_gate(spark):
    frames = sources(spark)
    report = q.check_report(frames, checks.source_rules(F.lit(D(2024, 6, 1)))).collect()
    failed = {(r.table_name, r.check_name, r.status) for r in report if r.violations}
    assert failed == {("sessions", "accepted_values_device_category", "warn")} or failed == set()
    gate = {(r.kind, r.subject): r.amount for r in checks.source_gate(frames).collect()}
    assert gate[("row_count", "users")] == 5
    assert gate[("orphans", "transactions.session_id -> sessions.session_id")] == 1
    assert gate[("orphans", "product_returns.item_id -> transactionsanditems.item_id")] == 0
    assert gate[("unexpected_values", "users.user_gender")] == 0


def test_source_invariants(spark):
    rows = {r.invariant: r.violations for r in checks.source_invariants(sources(spark)).collect()}
    assert rows["order revenue is the sum of its units"] == 0
    assert rows["order total is revenue plus shipping"] == 1
    assert rows["a unit row has quantity one"] == 0
    assert rows["purchase events and only they name a transaction"] == 0
    assert rows["a version changes a tracked attribute"] == 0
    assert rows["a tier is set exactly for members"] == 1
    # Customers 8 and `bad` start later than they registered.
    assert rows["the oldest version starts at registration"] == 2


def test_release_validation_runs_in_order(spark):
    src = sources(spark)["transactions"]
    from tillstar.plans import staging

    steps = checks.validate_before_release(src, staging.transactions(src))
    assert list(steps) == ["profile", "null_comparison", "relationship", "columns"]
    assert {r.status for r in steps["columns"].collect()} == {"ok"}
    assert steps["relationship"].first().orphaned_records == 0
    assert steps["null_comparison"].first().verdict == "more nulls"


def test_declared_check_totals():
    """The numbers of declared checks by kind."""
    rules = (
        checks.source_rules(F.lit(D(2024, 1, 1))) + checks.listing_rules() + checks.core_rules()
        + checks.mart_rules(audited=True) + checks.competitor_rules()
    )
    kinds = {}
    for rule in rules:
        kind = next(
            k for k in (
                "not_null", "unique_combination", "unique", "relationship", "accepted_range",
                "accepted_values", "injection_scan",
            ) if rule.name.startswith(k)
        )
        kinds[kind] = kinds.get(kind, 0) + 1
    assert kinds["unique_combination"] == 7
    assert kinds["injection_scan"] == 2
    assert kinds["accepted_values"] == 11
    assert kinds["accepted_range"] == 20
    assert kinds["unique"] == 28
    assert kinds["relationship"] == 21
    assert kinds["not_null"] == 81


def test_schema_of_every_source(spark):
    drift = q.schema_drift(
        spark, {n: f.schema for n, f in sources(spark).items()},
        {n: {f.name: f.dataType.simpleString() for f in s.fields} for n, s in SOURCES.items()},
    )
    assert {r.test_result for r in drift.collect()} == {"all_okay"}
    assert isinstance(SOURCES["users"]["valid_from"].dataType, T.DateType)


def test_profiles_count_distinct_values_without_expanding_rows(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("a", -0.0, 2), (None, 0.0, 2), ("b", None, None)], "k string, v double, n int"
    )
    profile = q.null_profile(df, ["k", "v", "n"], "t")
    rows = {r.column_name: (r.total_records, r.non_null_records, r.unique_values) for r in profile.collect()}
    assert rows == {"k": (4, 3, 2), "v": (4, 3, 2), "n": (4, 3, 2)}
    none = q.null_profile(df.limit(0), ["k", "v"], "t").collect()
    assert {(r.total_records, r.null_records, r.unique_values) for r in none} == {(0, 0, 0)}
    sales = df.select(
        F.col("k").alias("transaction_id"), F.col("n").alias("customer_id"),
        F.current_date().alias("date"), F.col("v").alias("transaction_total"),
    )
    for made in (profile, q.profile(sales), q.compare_nulls(df, df, ["k", "v"])):
        assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    r = q.profile(sales).first()
    assert (r.total_records, r.unique_users, r.unique_keys, r.distinct_days, r.null_users) == (4, 2, 2, 1, 1)
