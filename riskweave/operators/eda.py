"""Exploratory aggregates.

Simple statistics come from one wide aggregate whose single result row is
unpivoted; grouped statistics unpivot the input into (column, value) pairs
that are combined map-side before the shuffle; quantiles are exact (see
``functions.ordered``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import as_category, binary_target, col, dtype_of, has_times, parse_timestamp, to_double
from riskweave.functions.ordered import exact_quantiles
from riskweave.operators.audit import duplicate_rows
from riskweave.roles import Roles, candidates, categorical_columns, detect_amount_column, numeric_columns
from riskweave.session import written

MISSING = "<missing>"
DESCRIBE_PROBS = [0.25, 0.5, 0.75, 0.95]
# Weekday names in Monday-first order.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _rows_of(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def as_text(df: DataFrame, name: str) -> Column:
    """Categorical value as text, NULL → ``<missing>`` (booleans as True/False)."""
    return F.coalesce(as_category(df, name), F.lit(MISSING))


# --------------------------------------------------------------------------- E1
def target_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """For each column, whether it is a usable binary target
    (non-empty set of non-null values, all within {0, 1})."""
    aggs = []
    for i, c in enumerate(columns):
        v = to_double(col(c), dtype_of(df, c))
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v.isNotNull() & ~v.isin(0.0, 1.0)).alias(f"b{i}")]
    one = df.agg(*aggs)
    return _rows_of(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").cast("bigint").alias("non_null"),
                F.col(f"b{i}").cast("bigint").alias("invalid"),
                ((F.col(f"n{i}") > 0) & (F.col(f"b{i}") == 0)).alias("is_binary"),
            )
            for i, c in enumerate(columns)
        ],
    )


# --------------------------------------------------------------------------- E3
def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and share (rounded to 4) per target value incl. NULL, and
    the positive rate over non-null values."""
    y = binary_target(col(target), dtype_of(df, target))
    counts = df.groupBy(y.alias("target_value")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(y).alias("__pos"), F.count(y).alias("__nn")
    )
    # at most three rows (0, 1, NULL): a window over them is free
    w = Window.partitionBy()
    return counts.select(
        "target_value",
        F.col("count").cast("bigint").alias("count"),
        F.round(F.col("count") / F.sum("count").over(w), 4).alias("share"),
        (F.sum("__pos").over(w) / F.sum("__nn").over(w)).alias("positive_rate"),
    )


# --------------------------------------------------------------------------- E4
def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, p25, p50, p75, p95, max per numeric column."""
    columns = columns if columns is not None else numeric_columns(df)
    vals = {c: to_double(col(c), dtype_of(df, c)) for c in columns}
    one = df.agg(
        *[
            agg
            for i, c in enumerate(columns)
            for agg in (
                F.count(vals[c]).alias(f"c{i}"),
                F.avg(vals[c]).alias(f"a{i}"),
                F.stddev_samp(vals[c]).alias(f"s{i}"),
                F.min(vals[c]).alias(f"mn{i}"),
                F.max(vals[c]).alias(f"mx{i}"),
            )
        ]
    )
    simple = _rows_of(
        one,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"c{i}").cast("bigint").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("std"),
                F.col(f"mn{i}").alias("min"),
                F.col(f"mx{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ],
    )
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), vals[c].alias("v")) for c in columns])).alias("r")).select("r.*")
    qs = exact_quantiles(long, "v", DESCRIBE_PROBS, ["column_name"], ["p25", "p50", "p75", "p95"]).drop("n")
    # both sides have one row per column
    return simple.join(F.broadcast(qs), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "p95", "max"
    )


# --------------------------------------------------------------------------- E5
def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """E5: pairwise-complete Pearson correlation, one row per ordered pair."""
    columns = columns if columns is not None else numeric_columns(df)
    vals = {c: to_double(col(c), dtype_of(df, c)) for c in columns}
    pairs = [(i, j) for i in range(len(columns)) for j in range(len(columns)) if i <= j]
    one = df.agg(*[F.corr(vals[columns[i]], vals[columns[j]]).alias(f"r{i}_{j}") for i, j in pairs])
    structs = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            key = f"r{min(i, j)}_{max(i, j)}"
            structs.append(
                F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.nanvl(F.col(key), F.lit(None)).alias("corr"))
            )
    return _rows_of(one, structs)


# --------------------------------------------------------------------------- E6
def amount_summary(df: DataFrame, amount: str) -> DataFrame:
    """Min, median, mean, p95, max of the non-null amounts."""
    v = to_double(col(amount), dtype_of(df, amount))
    base = df.select(v.alias("v"))
    simple = base.agg(F.min("v").alias("min"), F.avg("v").alias("mean"), F.max("v").alias("max"), F.lit(1).alias("__k"))
    qs = exact_quantiles(base, "v", [0.5, 0.95], names=["median", "p95"]).withColumn("__k", F.lit(1))
    return simple.join(qs, "__k").select("min", "median", "mean", "p95", "max")


# --------------------------------------------------------------------------- E7
#: Groups of a histogram whose bounds are sent to every task; more are joined by shuffle.
FEW_GROUPS = 10_000


def _sent(table: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(table) if few else table


def histogram(
    df: DataFrame,
    value: Column,
    max_bins: int = 30,
    min_bins: int = 5,
    group: Column | None = None,
    basis: str = "ndv",
) -> DataFrame:
    """Equal-width histogram with ``min(max_bins, max(min_bins, k))``
    bins per group, k = distinct values (``basis="ndv"``) or values
    (``basis="count"``); numpy rules: last bin closed, a constant column
    spans value ± 0.5. Every bin is present, empty ones with count 0."""
    g = group if group is not None else F.lit(0)
    base = df.select(g.alias("__g"), value.alias("v")).where(F.col("v").isNotNull())
    stats = base.groupBy("__g").agg(
        F.min("v").alias("lo0"),
        F.max("v").alias("hi0"),
        F.approx_count_distinct("v").alias("__approx"),
        F.count("v").alias("__count"),
    )
    # exact distinct count only where it can change the bin count (few values)
    stats = written(stats, "histogram-groups")
    few = stats.count() <= FEW_GROUPS
    small = base.join(_sent(stats.where(F.col("__approx") <= 4 * max_bins).select("__g"), few), "__g").groupBy("__g").agg(
        F.count_distinct("v").alias("__ndv")
    )
    k = F.col("__count") if basis == "count" else F.coalesce(F.col("__ndv"), F.col("__approx"))
    stats = stats.join(_sent(small, few), "__g", "left").select(
        "__g",
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
        F.least(F.lit(max_bins), F.greatest(F.lit(min_bins), k)).alias("bins"),
    )
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    idx = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.col("bins") - 1).cast("int")
    counts = base.join(_sent(stats, few), "__g").groupBy("__g", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = stats.select("__g", "lo", "hi", "bins", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    out = spine.join(counts, ["__g", "bin"], "left").select(
        "__g",
        F.col("bin").cast("bigint").alias("bin"),
        (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.col("bins")).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.col("bins")).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )
    return out if group is not None else out.drop("__g")


def histogram_by_count(df: DataFrame, value: Column, group: Column, max_bins: int, min_bins: int) -> DataFrame:
    """Y9 flavour: bins from the number of values per group."""
    return histogram(df, value, max_bins, min_bins, group, basis="count").withColumnRenamed("__g", "group")


# --------------------------------------------------------------------------- E8
def top_values(df: DataFrame, columns: list[str] | None = None, top_n: int = 10) -> DataFrame:
    """The ``top_n`` most frequent values per categorical column, NULL as
    ``<missing>``, ties by value ascending."""
    columns = columns if columns is not None else categorical_columns(df)
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), as_text(df, c).alias("value")) for c in columns])).alias("r")
    ).select("r.*")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top_n)
        .select("column_name", F.col("rank").cast("bigint"), "value", F.col("count").cast("bigint"))
    )


# --------------------------------------------------------------------------- E9
def group_candidates(
    df: DataFrame, target: str | None, max_ndv: int = 20, max_ratio: float = 0.5
) -> DataFrame:
    """Categorical columns other than target and id candidates, with
    their distinct count and eligibility (ndv ≤ 20 and ndv/rows ≤ 0.5).

    A column with more than ``max_ndv`` values has a NULL count and
    ``over_limit`` set: it can't be eligible, so it is not counted exactly."""
    schema = "column_name string, n_distinct bigint, over_limit boolean, eligible boolean"
    excluded = {*candidates(df, "user_id"), *candidates(df, "transaction_id"), target}
    cols = [c for c in categorical_columns(df) if c not in excluded]
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    from riskweave.operators.features import distinct_counts

    ndv, n = distinct_counts(df, cols, max_ndv, with_rows=True)
    rows = [(c, ndv[c], ndv[c] is None, ndv[c] is not None and ndv[c] / max(n, 1) <= max_ratio) for c in cols]
    return df.sparkSession.createDataFrame(rows, schema)


# -------------------------------------------------------------------------- E10
def rate_by_group(df: DataFrame, target: str, columns: list[str], top_n: int = 10) -> DataFrame:
    """Positive rate and non-null target count per (column, value), the
    ``top_n`` by rate desc, count desc (value asc as final tie-break)."""
    y = binary_target(col(target), dtype_of(df, target))
    long = df.select(
        y.alias("__y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), as_text(df, c).alias("value")) for c in columns])).alias("r"),
    ).select("__y", "r.*")
    g = long.groupBy("column_name", "value").agg(F.avg("__y").alias("positive_rate"), F.count("__y").alias("count"))
    w = Window.partitionBy("column_name").orderBy(F.desc_nulls_last("positive_rate"), F.desc("count"), F.asc("value"))
    return (
        g.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top_n)
        .select("column_name", F.col("rank").cast("bigint"), "value", "positive_rate", F.col("count").cast("bigint"))
    )


# -------------------------------------------------------------------------- E11
def best_group(rates: DataFrame, columns: list[str]) -> DataFrame:
    """The column with the largest max−min rate gap among its kept rows;
    the earliest column wins ties. ``rates`` is the output of E10."""
    pos = {c: i for i, c in enumerate(columns)}
    order = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    gaps = rates.groupBy("column_name").agg(
        F.coalesce(F.max("positive_rate") - F.min("positive_rate"), F.lit(0.0)).alias("gap")
    )
    return gaps.orderBy(F.desc("gap"), order[F.col("column_name")]).limit(1)


# -------------------------------------------------------------------------- E12
def amount_by_target(df: DataFrame, target: str, amount: str) -> DataFrame:
    """Amount p25/p50/p75/p95 per class; rows with a NULL on either side
    dropped; empty unless both classes remain."""
    y = binary_target(col(target), dtype_of(df, target))
    v = to_double(col(amount), dtype_of(df, amount))
    base = df.select(y.alias("target_value"), v.alias("v")).where(F.col("target_value").isNotNull() & F.col("v").isNotNull())
    qs = exact_quantiles(base, "v", DESCRIBE_PROBS, ["target_value"], ["p25", "p50", "p75", "p95"]).drop("n")
    # at most two rows: require both classes
    w = Window.partitionBy()
    return qs.withColumn("__k", F.count(F.lit(1)).over(w)).where(F.col("__k") >= 2).drop("__k")


# ---------------------------------------------------------------------- E13/E14
def rate_by_hour(df: DataFrame, ts: str, target: str) -> DataFrame:
    """Positive rate by hour of day, all 24 hours present (NULL rate when
    an hour has no rows)."""
    t = parse_timestamp(col(ts), dtype_of(df, ts))
    y = binary_target(col(target), dtype_of(df, target))
    base = df.select(F.hour(t).alias("hour"), y.alias("y")).where(F.col("hour").isNotNull() & F.col("y").isNotNull())
    g = base.groupBy("hour").agg(F.avg("y").alias("positive_rate"), F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return spine.join(g, "hour", "left").select(
        F.col("hour").cast("bigint"), "positive_rate", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")
    )


def rate_by_weekday(df: DataFrame, ts: str, target: str) -> DataFrame:
    """Positive rate by weekday in Monday..Sunday order, all 7 present."""
    t = parse_timestamp(col(ts), dtype_of(df, ts))
    y = binary_target(col(target), dtype_of(df, target))
    base = df.select(F.weekday(t).alias("day_index"), y.alias("y")).where(
        F.col("day_index").isNotNull() & F.col("y").isNotNull()
    )
    g = base.groupBy("day_index").agg(F.avg("y").alias("positive_rate"), F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.createDataFrame(list(enumerate(DAY_NAMES)), "day_index int, day_name string")
    return spine.join(g, "day_index", "left").select(
        F.col("day_index").cast("bigint"),
        "day_name",
        "positive_rate",
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


# -------------------------------------------------------------------------- E15
@dataclass
class EdaReport:
    """Every block as a lazy DataFrame plus notes for skipped blocks."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)


def dataset_summary(df: DataFrame, roles: Roles) -> DataFrame:
    """E15 head block: rows, columns, duplicates and the chosen roles."""
    dup = duplicate_rows(df)
    return dup.select(
        F.col("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.col("duplicate_rows"),
        F.lit(roles.target).cast("string").alias("target_column"),
        F.lit(roles.timestamp).cast("string").alias("timestamp_column"),
        F.lit(roles.user_id).cast("string").alias("user_id_column"),
        F.lit(roles.transaction_id).cast("string").alias("transaction_id_column"),
    )


def run_full_eda(df: DataFrame, roles: Roles, target_valid: bool | None = None, shared: bool = False) -> EdaReport:
    """All blocks; blocks whose inputs are missing are skipped with a note.

    With ``shared`` the source, which may be text or a join, is read once into a columnar table, of which
    every block then reads its own columns.
    """
    from riskweave.functions.columns import binary_target_check

    if shared:
        df = written(df, "eda")
    rep = EdaReport()
    rep.tables["dataset_summary"] = dataset_summary(df, roles)
    if target_valid is None:
        target_valid = binary_target_check(df, roles.target)
    num = numeric_columns(df)
    if num:
        rep.tables["describe"] = describe(df, num)
    if len(num) >= 2:
        rep.tables["correlation"] = correlation(df, num)
    else:
        rep.notes.append("correlation needs two numeric columns")
    amount = detect_amount_column(df)
    if amount:
        rep.tables["amount_summary"] = amount_summary(df, amount)
        rep.tables["amount_histogram"] = histogram(df, to_double(col(amount), dtype_of(df, amount)))
    else:
        rep.notes.append("no amount column: amount tables left out")
    cats = categorical_columns(df)
    if cats:
        rep.tables["top_values"] = top_values(df, cats)
    else:
        rep.notes.append("no text or boolean columns: value counts left out")
    if target_valid:
        rep.tables["target_distribution"] = target_distribution(df, roles.target)
        cand = group_candidates(df, roles.target)
        eligible = [r["column_name"] for r in cand.where("eligible").collect()]
        if eligible:
            rates = rate_by_group(df, roles.target, eligible)
            rep.tables["rate_by_group"] = rates
            rep.tables["best_group"] = best_group(rates, eligible)
        if amount:
            rep.tables["amount_by_target"] = amount_by_target(df, roles.target, amount)
        if roles.timestamp and not has_times(df, roles.timestamp):
            rep.notes.append(f"no value of {roles.timestamp} can be read as a time: rates by hour and weekday left out")
        elif roles.timestamp:
            rep.tables["rate_by_hour"] = rate_by_hour(df, roles.timestamp, roles.target)
            rep.tables["rate_by_weekday"] = rate_by_weekday(df, roles.timestamp, roles.target)
    else:
        rep.notes.append("no 0/1 target: rates and comparisons by target left out")
    return rep


def report_rows(rep: EdaReport) -> DataFrame:
    """All blocks and notes of a report as one table: block, and each of its rows as JSON."""
    parts = [t.select(F.lit(name).alias("block"), F.to_json(F.struct(*t.columns), {"ignoreNullFields": "false"}).alias("row")) for name, t in rep.tables.items()]
    spark = parts[0].sparkSession
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    notes = spark.createDataFrame([("note", n) for n in rep.notes], "block string, row string")
    return out.unionByName(notes)
