"""Exact order statistics without a single-partition window.

``ordered_prefix`` adds running sums in the order of one numeric column
(optionally per group). The input is first collapsed to distinct
(group, value) rows, so a value shared by a third of all rows is one row.
Those rows are cut into up to ``buckets`` value ranges per group, with
bounds from ``percentile_approx`` over the raw rows (one aggregate, fixed
memory); each bucket is sorted on its own and shifted by the totals of the
buckets before it (a table of at most 2^20 rows, broadcast).

``at_ranks`` finds the values at a few ranks without ordering the rest (a
sketched bracket, counts, and the rows inside). ``exact_quantiles`` builds on it:
pandas/DuckDB linear interpolation between the values at 0-based ranks floor(h)
and ceil(h), h = (n - 1) q.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 1024
# distinct rows per bucket the bucket count aims at (a bucket is sorted by
# one task); small groups get one bucket, large ones up to DEFAULT_BUCKETS
ROWS_PER_BUCKET = 200_000
MAX_BROADCAST_GROUPS = 10_000
MAX_OFFSET_ROWS = 1 << 20
# cells of the second bucketing level (the JVM Bucketizer gets one split per
# cell; building it from Python costs about 80 µs per split)
MAX_REFINED_CELLS = 1 << 16


def bucket_expr(value: Column, bounds: list[float]) -> Column:
    """Number of ``bounds`` strictly below ``value`` as a balanced CASE tree
    (log2(len) comparisons per row, stays inside whole-stage codegen)."""
    bounds = sorted(set(b for b in bounds if b is not None))

    def tree(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]; bounds[lo:hi] decide it
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds))


def _bounds_by_group(
    df: DataFrame, value: str, groups: list[str], buckets: int
) -> dict[tuple, tuple[list[float], float, float, int]]:
    """Per group: approximate quantile bounds, min, max and row count (one aggregate)."""
    probs = [i / buckets for i in range(1, buckets)]
    aggs = [
        F.percentile_approx(F.col(value), probs, max(10_000, 10 * buckets)).alias("b"),
        F.min(F.col(value)).cast("double").alias("lo"),
        F.max(F.col(value)).cast("double").alias("hi"),
        F.count(F.col(value)).alias("n"),
    ]
    rows = (df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)).limit(MAX_BROADCAST_GROUPS + 1).collect()
    if len(rows) > MAX_BROADCAST_GROUPS:
        raise ValueError(f"ordered_prefix supports at most {MAX_BROADCAST_GROUPS} groups")
    return {
        tuple(r[g] for g in groups): (list(r["b"] or []), r["lo"], r["hi"], r["n"]) for r in rows if r["lo"] is not None
    }


def _unit_key(v, gi, lo, hi):
    """Group index plus the value scaled into [0.1, 0.9] by its group's
    min/max: monotone non-decreasing in the value, groups kept apart, and
    precise to about (hi − lo)·1e-16 (an ``atan`` squash loses all
    resolution for values such as epoch microseconds). Works on Columns and
    on Python floats alike."""
    return gi + 0.1 + 0.8 * ((v - lo) / (hi - lo))


def _refine_buckets(keyed: DataFrame, value: str, groups: list[str], rows_per_bucket: int, cells: int) -> DataFrame:
    """Second bucketing level: each (group, bucket) is cut again by its own
    approximate quantiles (one grouped aggregate over the distinct rows),
    into about rows/``rows_per_bucket`` cells, at most ``MAX_REFINED_CELLS``
    in all. Cells get consecutive ids in (group, bucket, sub-range) order, so
    the new bucket id stays monotone in the value within a group. The
    distinct rows are read twice (sub-bounds, then the final plan), so they
    are checkpointed once (shared folder) instead of re-shuffled."""
    from pyspark.ml.feature import Bucketizer

    from riskweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(keyed.sparkSession)  # the cluster's shared folder, if set
    keyed = keyed.checkpoint()
    sub = max(2, min(1024, MAX_REFINED_CELLS // max(1, cells)))
    probs = [i / sub for i in range(1, sub)]
    rows = (
        keyed.groupBy(*groups, "__bucket")
        .agg(
            F.percentile_approx(F.col(value), probs, max(10_000, 10 * sub)).alias("b"),
            F.min(F.col(value)).cast("double").alias("lo"),
            F.max(F.col(value)).cast("double").alias("hi"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    )  # ≤ MAX_OFFSET_ROWS rows of ≤ sub bounds, checked by the caller's cap
    order = sorted(rows, key=lambda r: (tuple((r[g] is None, str(r[g])) for g in groups), r["__bucket"]))
    splits = {float("-inf"), float("inf")}
    table = []
    for bi, r in enumerate(order):
        lo, hi, bs = r["lo"], r["hi"], list(r["b"] or [])
        k = max(1, min(sub, -(-r["n"] // max(1, rows_per_bucket))))
        step = (len(bs) + 1) / k
        chosen = [bs[int(round(i * step)) - 1] for i in range(1, k)] if k < len(bs) + 1 else bs
        splits.add(bi + 0.95)
        if hi > lo:
            for b in chosen:
                if b is not None and not math.isnan(b):
                    splits.add(_unit_key(float(b), bi, lo, hi))
        table.append((*[r[g] for g in groups], r["__bucket"], bi, lo, hi))
    gfields = keyed.select(*groups).schema.fields
    schema = ", ".join(
        [f"__rg{i} {f.dataType.simpleString()}" for i, f in enumerate(gfields)]
        + ["__rb double", "__bi int", "__blo double", "__bhi double"]
    )
    btab = keyed.sparkSession.createDataFrame(table, schema)
    cond = [keyed[g].eqNullSafe(btab[f"__rg{i}"]) for i, g in enumerate(groups)] + [keyed["__bucket"] == btab["__rb"]]
    # one row per (group, bucket): at most MAX_OFFSET_ROWS rows
    j = keyed.join(F.broadcast(btab), cond)
    v = F.col(value).cast("double")
    bi = F.col("__bi").cast("double")
    j = j.withColumn(
        "__key2",
        F.when(F.col("__bhi") > F.col("__blo"), _unit_key(v, bi, F.col("__blo"), F.col("__bhi"))).otherwise(bi + 0.5),
    )
    out = Bucketizer(splits=sorted(splits), inputCol="__key2", outputCol="__bucket2", handleInvalid="keep").transform(j)
    drop = [f"__rg{i}" for i in range(len(groups))] + ["__rb", "__bi", "__blo", "__bhi", "__key2", "__bucket"]
    return out.drop(*drop).withColumnRenamed("__bucket2", "__bucket")


def ordered_prefix(
    df: DataFrame,
    value: str,
    weights: dict[str, Column],
    groups: list[str] | None = None,
    buckets: int = DEFAULT_BUCKETS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Distinct (groups, value) rows with ``weights`` summed per value and
    inclusive running sums ``cum_<name>`` in ascending ``value`` order.

    NULL values are dropped. Output columns: groups, value, each weight, each
    ``cum_<weight>``.

    Bucketing: bounds are approximate quantiles of the raw rows per group,
    so a bucket holds about rows/buckets rows before the distinct step (and
    fewer after). Every row gets the key ``group_index + 0.1 + 0.8 ·
    (value − min) / (max − min)`` with its group's min and max, which keeps
    groups apart and is monotone in the value, and one JVM ``Bucketizer``
    (binary search over all groups' bounds) assigns buckets. A group gets
    about rows/``rows_per_bucket`` buckets (at least 1, at most
    ``buckets``); when every group fits in one bucket no bucketing is done.
    """
    from pyspark.ml.feature import Bucketizer

    groups = groups or []
    names = list(weights)
    raw = df.where(F.col(value).isNotNull())
    # one pass gives the groups, their bounds and their value ranges; with
    # many groups every group keeps fewer bounds so that groups × buckets
    # stays bounded
    bounds = _bounds_by_group(raw, value, groups, buckets)
    cap = max(2, min(buckets, MAX_OFFSET_ROWS // max(1, len(bounds))))

    def thin(bs: list[float], n: int) -> list[float]:
        k = max(1, min(cap, -(-n // max(1, rows_per_bucket))))
        if k >= len(bs) + 1:
            return bs
        step = (len(bs) + 1) / k
        return [bs[int(round(i * step)) - 1] for i in range(1, k)]

    # a group whose buckets would still be far above the target size gets a
    # second, per-bucket level below (only at very large inputs)
    refine = any(n > 4 * rows_per_bucket * (min(len(bs), cap - 1) + 1) for bs, _, _, n in bounds.values())
    bounds = {key: (thin(bs, n), lo, hi) for key, (bs, lo, hi, n) in bounds.items()}
    bucketed = any(bs for bs, _, _ in bounds.values())

    keys = sorted(bounds, key=lambda k: tuple((x is None, str(x)) for x in k))
    index = {k: i for i, k in enumerate(keys)}
    splits = {float("-inf"), float("inf")}
    for k, (bs, lo, hi) in bounds.items():
        gi = index[k]
        splits.add(gi + 0.95)
        if hi > lo:
            for b in bs:
                if b is not None and not math.isnan(b):
                    splits.add(_unit_key(float(b), gi, lo, hi))
    distinct = raw.groupBy(*groups, value).agg(*[F.sum(c).alias(n) for n, c in weights.items()])
    if groups:
        gfields = raw.select(*groups).schema.fields
        gschema = (
            ", ".join(f"__g{i} {f.dataType.simpleString()}" for i, f in enumerate(gfields))
            + ", __gi int, __lo double, __hi double"
        )
        gtab = distinct.sparkSession.createDataFrame(
            [(*k, i, bounds[k][1], bounds[k][2]) for k, i in index.items()], gschema
        )
        # one row per group (≤ MAX_BROADCAST_GROUPS, checked above)
        cond = [distinct[g].eqNullSafe(gtab[f"__g{i}"]) for i, g in enumerate(groups)]
        distinct = distinct.join(F.broadcast(gtab), cond).drop(*[f"__g{i}" for i in range(len(groups))])
    else:
        lo, hi = bounds[()][1:] if () in bounds else (0.0, 0.0)
        distinct = distinct.withColumns({"__gi": F.lit(0), "__lo": F.lit(lo), "__hi": F.lit(hi)})
    v = F.col(value).cast("double")
    distinct = distinct.withColumn(
        "__key",
        F.when(F.col("__hi") > F.col("__lo"), _unit_key(v, F.col("__gi").cast("double"), F.col("__lo"), F.col("__hi")))
        .otherwise(F.col("__gi").cast("double") + 0.5),
    ).drop("__lo", "__hi")
    if bucketed:
        keyed = (
            Bucketizer(splits=sorted(splits), inputCol="__key", outputCol="__bucket", handleInvalid="keep")
            .transform(distinct)
            .drop("__key", "__gi")
        )
    else:  # every group fits in one bucket
        keyed = distinct.withColumn("__bucket", F.lit(0.0)).drop("__key", "__gi")
    if refine:
        cells = sum(len(bs) + 1 for bs, _, _ in bounds.values())
        keyed = _refine_buckets(keyed, value, groups, rows_per_bucket, cells)

    totals = keyed.groupBy(*groups, "__bucket").agg(*[F.sum(n).alias(f"__t_{n}") for n in names])
    wt = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"__og{i}") for i, g in enumerate(groups)],
        F.col("__bucket").alias("__ob"),
        *[F.coalesce(F.sum(f"__t_{n}").over(wt), F.lit(0)).alias(f"__o_{n}") for n in names],
    )
    # offsets has at most groups x buckets ≤ MAX_OFFSET_ROWS rows: safe to broadcast.
    wl = Window.partitionBy(*groups, "__bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.select(*groups, value, "__bucket", *names, *[F.sum(n).over(wl).alias(f"__l_{n}") for n in names])
    cond = [F.col(g).eqNullSafe(F.col(f"__og{i}")) for i, g in enumerate(groups)] + [F.col("__bucket") == F.col("__ob")]
    joined = local.join(F.broadcast(offsets), cond, "left")
    return joined.select(
        *groups,
        value,
        *names,
        *[(F.col(f"__l_{n}") + F.col(f"__o_{n}")).alias(f"cum_{n}") for n in names],
    )


#: Steps of the rank grid, and the sketch's accuracy: a rank is off by at most rows / SKETCH.
GRID, SKETCH = 1000, 10_000
#: Bounds of so many groups are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 10_000
#: Distinct values that one task orders, and the parts into which a bracket with more of them is cut.
ORDERED, PARTS = 100_000, 64


def at_ranks(df: DataFrame, value: str, ranks: dict[str, Column], groups: list[str] | None = None) -> DataFrame:
    """Exact order statistics: the value at 0-based ranks of the ascending order.

    ``ranks`` maps a name to a rank, an expression of ``n`` (the group's non-null
    rows). Output: groups, n, rank_name, value, before (rows with smaller values)
    and count (rows with this value).

    Nothing is sorted as a whole. One aggregate sketches each group's values at a
    grid of ranks; two grid values around a wanted rank, further away than the
    sketch can be off, bracket it. A second pass counts the rows below each
    bracket and collapses the rows inside, about 3 / GRID of the group, to
    distinct values; only those are ordered. Where they may be more than ORDERED, the bracket is
    narrowed first (``_narrowed``). A rank outside its bracket, which
    the counts would show, raises an error.
    """
    spark = df.sparkSession
    groups = groups or []
    names = list(ranks)
    raw = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("__v"))
    grid = [i / GRID for i in range(GRID + 1)]
    sketch = [F.count(F.lit(1)).alias("n"), F.percentile_approx("__v", grid, SKETCH).alias("__grid")]
    stats = (raw.groupBy(*groups).agg(*sketch) if groups else raw.agg(*sketch)).where(F.col("n") > 0)
    margin = GRID / SKETCH * 3
    bounds = stats.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], "n", "__grid")
    for i, name in enumerate(names):
        place = ranks[name].cast("double") / F.col("n") * GRID
        step = F.ceil(F.lit(GRID) / F.col("n"))
        low = F.greatest(F.lit(0), F.floor(place - margin - step) - 1).cast("int")
        high = F.least(F.lit(GRID), F.ceil(place + margin + step) + 1).cast("int")
        bounds = bounds.withColumns(
            {
                f"__r{i}": ranks[name].cast("long"),
                f"__lo{i}": F.when(low > 0, F.element_at("__grid", low + 1)),
                f"__hi{i}": F.when(high < GRID, F.element_at("__grid", high + 1)),
            }
        )
    bounds = bounds.drop("__grid")

    from riskweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    bounds = bounds.checkpoint()  # read twice: here and at the end
    most = bounds.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("n")).first()
    few = not groups or most["groups"] <= BROADCAST_GROUPS
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    on = F.lit(True)
    for c in same:
        on = on & c
    near = raw.join(F.broadcast(bounds) if few else bounds, on)
    # Per wanted rank: rows below the bracket count under a NULL value, rows inside under their own.
    marks = [
        F.when(F.coalesce(F.col("__v") < F.col(f"__lo{i}"), F.lit(False)), F.struct(F.lit(i).alias("i"), F.lit(None).cast(raw.schema["__v"].dataType).alias("v")))
        .when(F.coalesce(F.col("__v") <= F.col(f"__hi{i}"), F.lit(True)), F.struct(F.lit(i).alias("i"), F.col("__v").alias("v")))
        for i in range(len(names))
    ]
    marked = near.select(*groups, F.explode(F.array_compact(F.array(*marks))).alias("__m"))
    counts = marked.groupBy(*groups, F.col("__m.i").alias("__i"), F.col("__m.v").alias("__v")).agg(F.count(F.lit(1)).alias("count"))
    # A bracket spans at most ten steps of the grid, the sketch's errors included.
    if (most["n"] or 0) * 10 > ORDERED * GRID:
        ends = F.array(*[F.col(f"__r{i}") for i in range(len(names))])
        counts = _narrowed(counts, bounds.select(*[c for c in bounds.columns if c.startswith("__g")], ends.alias("__ranks")), groups, few)
    upto = F.sum("count").over(
        Window.partitionBy(*groups, "__i").orderBy(F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = counts.withColumn("before", upto - F.col("count")).join(F.broadcast(bounds) if few else bounds, on)
    wanted = F.element_at(F.array(*[F.col(f"__r{i}") for i in range(len(names))]), F.col("__i") + 1)
    hit = placed.where((F.col("before") <= wanted) & (wanted < F.col("before") + F.col("count")))
    checked = F.when(F.col("__v").isNotNull(), F.col("__v")).otherwise(F.raise_error(F.lit("a rank lies outside its bracket")))
    return hit.select(
        *groups,
        "n",
        F.element_at(F.array(*[F.lit(x) for x in names]), F.col("__i") + 1).alias("rank_name"),
        checked.alias("value"),
        F.col("before").cast("long").alias("before"),
        F.col("count").cast("long").alias("count"),
    )


def _narrowed(counts: DataFrame, wanted: DataFrame, groups: list[str], few: bool) -> DataFrame:
    """``counts`` (groups, __i, __v, count; a null __v counts what is below) with at most ORDERED values a bracket.

    A bracket with more values is cut at PARTS quantiles of them; the parts' row counts tell the part with the
    wanted rank, and what is below that part joins the count below. Each round leaves about 1 / PARTS of the values;
    a part that is one value can't be cut and need not be.
    """
    key = [*groups, "__i"]
    order = Window.partitionBy(*key).orderBy(F.col("__part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    while True:
        counts = counts.checkpoint()
        sizes = counts.where(F.col("__v").isNotNull()).groupBy(*key)
        cuts = sizes.agg(F.count(F.lit(1)).alias("__size"), F.percentile_approx("__v", [i / PARTS for i in range(1, PARTS)], 10_000).alias("__cuts"))
        cuts = cuts.where(F.col("__size") > ORDERED).select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(key)], "__cuts").checkpoint()
        if cuts.isEmpty():
            return counts
        on = F.lit(True)
        for i, k in enumerate(key):
            on = on & F.col(k).eqNullSafe(F.col(f"__c{i}"))
        cut = counts.join(F.broadcast(cuts) if few else cuts, on, "left")
        part = F.when(F.col("__cuts").isNotNull() & F.col("__v").isNotNull(), F.size(F.filter("__cuts", lambda c: c < F.col("__v"))))
        cut = cut.select(*key, "__v", "count", F.col("__cuts").isNotNull().alias("__big"), part.alias("__part"))
        cut = cut.checkpoint()
        # At most PARTS + 1 rows a bracket from here to the choice of the part.
        parts = cut.where("__big").groupBy(*key, "__part").agg(F.sum("count").alias("n"))
        parts = parts.withColumn("upto", F.sum("n").over(order)).withColumn("below", F.col("upto") - F.col("n"))
        same = F.lit(True)
        for i, g in enumerate(groups):
            same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
        parts = parts.join(F.broadcast(wanted) if few else wanted, same)
        rank = F.element_at("__ranks", F.col("__i") + 1)
        # A rank below the bracket keeps its null part, for the caller's check.
        found = parts.where((F.col("below") <= rank) & (rank < F.col("upto")))
        found = found.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(key)], F.col("__part").alias("__chosen"), "below")
        kept = cut.where("__big").join(F.broadcast(found) if few else found, on).where(F.col("__part").eqNullSafe(F.col("__chosen")))
        below = found.where(F.col("__chosen").isNotNull()).select(
            *[F.col(f"__c{i}").alias(k) for i, k in enumerate(key)], F.lit(None).cast(counts.schema["__v"].dataType).alias("__v"), F.col("below").alias("count")
        )
        names = [*key, "__v", "count"]
        counts = cut.where("NOT __big").select(*names).unionByName(kept.select(*names)).unionByName(below)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    groups: list[str] | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles per group, one column per prob.

    Output: groups + one double column per prob named ``names[i]`` (default
    ``q<percent>``), plus ``n`` (non-null count). Groups with no non-null
    value are absent.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    groups = list(groups or [])
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = {f"{end}_{name}": cut(place(p)) for p, name in zip(probs, names) for end, cut in (("lo", F.floor), ("hi", F.ceil))}
    found = at_ranks(df, value, ranks, groups)
    ends = [F.max(F.when(F.col("rank_name") == r, F.col("value"))).cast("double").alias(f"__{r}") for r in ranks]
    wide = found.groupBy(*groups, "n").agg(*ends)
    out = [
        (F.col(f"__lo_{x}") + (place(p) - F.floor(place(p))) * (F.col(f"__hi_{x}") - F.col(f"__lo_{x}"))).alias(x)
        for p, x in zip(probs, names)
    ]
    return wide.select(*groups, F.col("n").cast("bigint").alias("n"), *out)
