"""Mixing sources to target weights (operator 9, DataFrame functions only).

Every row gets a hash-random key. Within each source the keys are cut into
ranges (the key is uniform, so equal ranges hold equal shares of the rows);
the size of each range is summed, the sums are added up in key order, and the
source's exact word budget falls into one range. Ranges below it are taken
whole, ranges above it are left, and only the one range that the budget cuts is
ordered row by row. A source whose target exceeds its size is repeated in
whole epochs first.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; sources of size 0 have target 0; rows of one id and size are
interchangeable; an empty table gives an empty result. Columns of the input
that share a name with an added column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch, n_words

#: Rows of one key range; more rows make more ranges.
RANGE_ROWS = 512


def ordered_positions(frame: DataFrame, column: str, scratch: Scratch) -> DataFrame:
    """Adds ``position``: the row's place from 0 in code point order, nulls last.

    Range partitions are ordered on their own; the counts of the partitions
    before give each one its first place.
    """
    parts = max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = scratch.write(
        frame.repartitionByRange(parts, F.col(column).asc_nulls_last()).withColumn("__part", F.spark_partition_id()),
        "ranged",
    )
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    first = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    first = first.select("__part", F.coalesce(before, F.lit(0)).alias("__first"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(column).asc_nulls_last())) - 1
    return (
        ranged.withColumn("__place", place)
        .join(first, "__part")
        .withColumn("position", (F.col("__first") + F.col("__place")).cast("long"))
        .drop("__part", "__place", "__first")
    )


def source_targets(
    sizes: DataFrame, scratch: Scratch, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, share: float = 1.0
) -> DataFrame:
    """``sizes`` (source, source_size, n_rows) plus ``target`` in words.

    Weights repeat over the sources in code point order. A target stops at
    ``max_epochs`` times its source's size; the excess is shared again by weight
    among the others until none is above. That fixed point gives every source
    that is not stopped the same words per weight, found by a few aggregates.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    placed = ordered_positions(sizes, "source", scratch).withColumn(
        "weight", F.element_at(listed, (F.col("position") % len(weights) + 1).cast("int"))
    )
    placed = scratch.write(placed.withColumn("most", F.col("source_size") * max_epochs), "weights")
    words, weight = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    total = (words or 0) * share
    stopped_words, stopped_weight, rate = 0, 0.0, 0.0
    while weight and stopped_weight < weight:
        rate = (total - stopped_words) / (weight - stopped_weight)
        row = placed.where(F.col("most") <= F.lit(rate) * F.col("weight")).agg(F.sum("most"), F.sum("weight")).first()
        again = (row[0] or 0, row[1] or 0.0)
        if again == (stopped_words, stopped_weight):
            break
        stopped_words, stopped_weight = again
    target = F.least(F.col("most").cast("double"), F.lit(float(rate)) * F.col("weight"))
    return placed.withColumn("target", target).select("source", "source_size", "n_rows", "target")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    max_epochs: int = 3,
    share: float = 1.0,
    seed: int = 7,
) -> DataFrame:
    """All rows of ``docs`` plus size, source_size, target and taken (words).

    ``taken`` counts repeats: whole epochs plus what the last, partial one
    takes. The words taken of a source sum to the whole part of its target.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    added = ("size", "source_size", "target", "taken")
    keep = [c for c in docs.columns if c not in added]
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(str(seed))))
    rows = docs.select(
        *keep, n_words(F.col(text_col)).alias("size"), F.col(source_col).alias("__source"), digest.alias("__key")
    ).withColumn("__unit", F.conv(F.substring("__key", 1, 8), 16, 10).cast("long"))

    sizes = rows.groupBy(F.col("__source").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    targets = source_targets(scratch.write(sizes, "sizes"), scratch, weights, max_epochs, share)
    budget = F.floor("target").cast("long")
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    # Ranges number about the square root of the rows once there are many, so neither
    # a range nor the list of ranges of a large source becomes long.
    per_range = F.greatest(F.lit(float(RANGE_ROWS)), F.sqrt(F.col("n_rows").cast("double")))
    plan = plan.withColumn("n_ranges", F.ceil(F.col("n_rows") / per_range).cast("long"))
    plan = scratch.write(plan.select(*[F.col(c).alias(f"__p_{c}") for c in plan.columns]), "plan")

    ranged = rows.join(plan, F.col("__source").eqNullSafe(F.col("__p_source"))).withColumn(
        "__range", F.floor(F.col("__unit") * F.col("__p_n_ranges") / (1 << 32)).cast("long")
    )
    rest, epochs = F.col("__p_rest"), F.col("__p_epochs")
    sums = ranged.groupBy("__source", "__range", "__p_rest").agg(F.sum("size").alias("__sum"))
    order = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__sum").over(order), F.lit(0))
    state = F.when(F.col("__before") + F.col("__sum") <= rest, 1).when(F.col("__before") >= rest, 0).otherwise(2)
    cuts = sums.withColumn("__before", before).withColumn("__state", state).where(F.col("__state") > 0)
    cuts = scratch.write(cuts.select(F.col("__source").alias("__s"), F.col("__range").alias("__r"), "__before", "__state"), "cuts")
    out = ranged.join(
        cuts, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")), "left"
    ).withColumn("__state", F.coalesce("__state", F.lit(0)))

    whole = epochs * F.col("size")
    others = out.where(F.col("__state") < 2).withColumn("taken", whole + F.col("__state") * F.col("size"))
    in_key_order = Window.partitionBy("__source", "__range").orderBy("__key", id_col, "size")
    earlier = F.coalesce(F.sum("size").over(in_key_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = out.where(F.col("__state") == 2).withColumn("__earlier", F.col("__before") + earlier)
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__earlier")))
    cut = cut.withColumn("taken", whole + part)
    columns = [F.col(c) for c in keep] + [
        F.col("size"),
        F.col("__p_source_size").alias("source_size"),
        F.col("__p_target").alias("target"),
        F.col("taken").cast("long").alias("taken"),
    ]
    return others.select(*columns).unionByName(cut.select(*columns))


#: The same result in DuckDB SQL (weights 5, 2, 1, at most 3 epochs, seed 7).
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), '7')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM {docs}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
             3 * source_size AS most FROM s),
o AS (SELECT *, coalesce(sum(most) OVER before, 0)::DOUBLE AS stopped, coalesce(sum(w) OVER before, 0)::DOUBLE AS gone,
             (sum(source_size) OVER ())::DOUBLE AS total, (sum(w) OVER ())::DOUBLE AS all_w
      FROM p WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT (total - stopped) / (all_w - gone) AS rate FROM o WHERE most / w > (total - stopped) / (all_w - gone)
      ORDER BY most / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(most::DOUBLE, coalesce((SELECT rate FROM r), 0) * w) AS target FROM p),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
c AS (SELECT *, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest FROM b),
x AS (SELECT d.*, c.source_size, c.target, c.epochs, c.rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
"""
MIX_SELECT = """
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - earlier)) AS BIGINT) AS taken
FROM x
"""
