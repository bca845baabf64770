"""URL rules, and the ratio of two character language models where no rule fits."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import Tables, column

#: Verdict, host and path of each rule (fixed values of the contract).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Characters of context, and the chance of a character where nothing was counted.
ORDER = 4
UNSEEN = 1 / 256
START, END = "\u0002", "\u0003"
#: Characters of a URL that are cut into grams at once.
PIECE = 64
#: Log-likelihoods are summed as whole numbers of 1 / SCALE, so that the order can't matter;
#: thresholds are whole numbers of 1 / STEPS, between -REACH and REACH.
SCALE, STEPS, REACH = 1_000_000, 1000, 20_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without `://` and for null."""
    known = F.coalesce(url, F.lit(""))
    rest = F.when(
        F.instr(known, "://") > 0, F.substring_index(known, "://", 1)
    )
    after = F.substring(known, F.length(rest) + F.lit(4), F.length(known))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; of equally long ones that of the longer
    host, and block before allow."""
    rule = verdict = None
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    for what, name, start in ordered:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = (F if rule is None else rule).when(fits, F.lit(name + start))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(what))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _grams(seen: DataFrame, order: int) -> DataFrame:
    """Each character of `url`, and its end, with the `order` characters before it.

    A place in a string is found by counting from its start, so URLs are cut into pieces of
    PIECE characters first, each followed by the `order` characters after it.
    """
    padded = F.concat(F.lit(START * order), F.col("url"), F.lit(END))
    found = F.regexp_extract_all(padded, F.lit(f"(?s).{{1,{max(PIECE, order)}}}"), F.lit(0))
    later = F.slice(found, 2, F.size(found))
    ahead = F.coalesce(F.substring(F.element_at("pair", 2), 1, order), F.lit(""))
    pairs = seen.withColumn("pair", F.explode(F.zip_with(found, later, lambda a, b: F.array(a, b))))
    pieces = pairs.withColumn("piece", F.concat(F.element_at("pair", 1), ahead)).drop("pair")
    places = F.when(F.length("piece") > order, F.sequence(F.lit(1), F.length("piece") - order))
    return pieces.withColumn(
        "gram",
        F.explode(F.transform(places, lambda at: F.substring("piece", at, F.lit(order + 1)))),
    ).drop("piece")


#: The three models: without the URLs of fold 0, without those of fold 1, and with all.
def _counts(kind: str) -> list[Column]:
    even, odd = F.col(f"{kind}0"), F.col(f"{kind}1")
    return [odd, even, even + odd]


def chances(tables: Tables, grams: DataFrame, order: int) -> DataFrame:
    """For every gram the chance of its last character after the others, by model and class.

    Variable-order Markov model with Witten-Bell smoothing: the count of the gram and, weighted
    with the number of characters seen after the context, the chance in the context that is
    shorter by one. Orders are joined from the shortest up; all tables hold one row a gram.
    """
    levels = [grams]
    for _ in range(order):
        levels.append(
            levels[-1]
            .groupBy(F.expr("substring(gram, 2)").alias("gram"))
            .agg(*[F.sum(c).alias(c) for c in ("a0", "a1", "r0", "r1")])
        )
    names = [f"{kind}{m}" for kind in "ar" for m in range(3)]
    shorter = None
    for width, level in zip(range(1, order + 2), reversed(levels), strict=True):
        context = Window.partitionBy("context")
        level = level.withColumn("context", F.expr(f"substring(gram, 1, {width - 1})"))
        level = level.withColumn("suffix", F.expr("substring(gram, 2)"))
        plain = [c for kind in "ar" for c in _counts(kind)]
        told = level.select(
            "gram", "suffix",
            *[c.alias(f"n_{n}") for c, n in zip(plain, names, strict=True)],
            *[F.sum(c).over(context).alias(f"t_{n}") for c, n in zip(plain, names, strict=True)],
            *[
                F.sum((c > 0).cast("long")).over(context).alias(f"d_{n}")
                for c, n in zip(plain, names, strict=True)
            ],
        )
        if shorter is not None:
            told = told.join(
                shorter.select(F.col("gram").alias("suffix"), *[F.col(n) for n in names]), "suffix"
            )
        shorter = told.select("gram", *[
            F.when(F.col(f"d_{n}") == 0, low)
            .otherwise((F.col(f"n_{n}") + F.col(f"d_{n}") * low) / (F.col(f"t_{n}") + F.col(f"d_{n}")))
            .alias(n)
            for n in names
            for low in [F.lit(UNSEEN) if width == 1 else F.col(n)]
        ])
        shorter = tables.write(f"order{width}", shorter)
    return shorter


def url_scores(df: DataFrame, url: str = "url", rules=RULES, order: int = ORDER):
    """Score of every distinct URL and the calibrated threshold.

    URLs that a rule allows are the accepted ones, those that a rule blocks the rejected ones;
    all of them are counted. The score is the difference of the log-likelihoods under the two
    models, divided by the number of characters. The threshold is the one that parts the
    accepted and rejected URLs with the least sum of both error rates, where each URL is
    scored without the URLs of its own half; it is 0 if either kind is missing.
    """
    tables = Tables(df.sparkSession, "urls")
    host, path = host_and_path(F.col("url"))
    _, verdict = best_rule(host, path, rules)
    seen = df.select(column(url).cast("string").alias("url")).where(F.col("url").isNotNull())
    seen = seen.distinct().select(
        "url",
        F.monotonically_increasing_id().alias("id"),
        F.when(verdict == "allow", "a").when(verdict == "block", "r").alias("kind"),
        F.pmod(F.xxhash64("url"), F.lit(2)).cast("int").alias("fold"),
    )
    seen = tables.write("seen", seen)
    each = _grams(seen, order).select("id", "kind", "fold", "gram")
    grams = tables.write(
        "grams",
        each.groupBy("gram").agg(*[
            F.count(F.when((F.col("kind") == kind) & (F.col("fold") == fold), 1)).alias(f"{kind}{fold}")
            for kind in "ar" for fold in (0, 1)
        ]),
    )
    model = chances(tables, grams, order)
    ratio = [
        F.round((F.log(f"a{m}") - F.log(f"r{m}")) * SCALE).cast("long").alias(f"m{m}")
        for m in range(3)
    ]
    sums = (
        each.join(model.select("gram", *ratio), "gram")
        .groupBy("id", "kind", "fold")
        .agg(
            F.sum("m2").alias("all"),
            F.sum(F.when(F.col("fold") == 0, F.col("m0")).otherwise(F.col("m1"))).alias("other"),
            F.count(F.lit(1)).alias("length"),
        )
    )
    sums = tables.write("sums", sums)
    scored = seen.select("id", "url").join(
        sums.select("id", (F.col("all") / F.col("length") / SCALE).alias("score")), "id"
    )
    return scored.drop("id"), threshold(sums)


def threshold(sums: DataFrame) -> float:
    """The middle of the widest gap that parts cross-scored URLs of known class with the least
    sum of error rates; at most 2 * REACH + 1 bins are compared."""
    step = F.col("other") / F.col("length") / SCALE * STEPS
    bins = (
        sums.where(F.col("kind").isNotNull())
        .groupBy(F.least(F.greatest(F.floor(step), F.lit(-REACH)), F.lit(REACH)).alias("bin"))
        .agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in "ar"])
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    lost = F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(every)
    let = 1 - F.coalesce(F.sum("r").over(below), F.lit(0)) / F.sum("r").over(every)
    before = F.coalesce(F.lag("bin").over(Window.orderBy("bin")), F.col("bin"))
    best = (
        bins.select(
            (lost + let).alias("error"), (F.col("bin") - before).alias("gap"),
            ((F.col("bin") + before) / 2).alias("cut"),
        )
        .where(F.col("error").isNotNull())
        .orderBy("error", F.desc("gap"), F.abs("cut"), "cut")
        .first()
    )
    return best["cut"] / STEPS if best else 0.0


def judged_urls(
    df: DataFrame,
    url: str = "url",
    keep: list[str] | None = None,
    rules=RULES,
    order: int = ORDER,
) -> DataFrame:
    """Judge every URL: the longest fitting rule decides, else the models' score.

    Adds host, path, rule (null if none fits), verdict (allow or block) and score (null where a
    rule decides). Without a rule, a URL is allowed if its score reaches the threshold.

    A null URL, or one without `://`, has an empty host and path and so no rule; a null URL
    scores 0. Repeated URLs are scored once and count once in the models. An empty table stays
    empty. Input columns named like a new column give way to it.
    """
    new = ["host", "path", "rule", "verdict", "score"]
    carried = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    scores, least = url_scores(df, url, rules, order)
    rows = df.select(*[column(c) for c in carried], column(url).cast("string").alias("__llm_url"))
    host, path = host_and_path(F.col("__llm_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    none = F.lit(None).cast("double")
    ruled = rows.where(F.col("rule").isNotNull()).withColumn("score", none)
    bare = rows.where(F.col("rule").isNull() & F.col("__llm_url").isNull())
    bare = bare.withColumn("score", F.lit(0.0))
    rest = rows.where(F.col("rule").isNull() & F.col("__llm_url").isNotNull())
    rest = rest.join(scores.withColumnRenamed("url", "__llm_url"), "__llm_url")
    judged = bare.unionByName(rest).withColumn(
        "verdict", F.when(F.col("score") >= least, "allow").otherwise("block")
    )
    return ruled.unionByName(judged).select(*[column(c) for c in carried], *new)
