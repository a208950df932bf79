"""Exact order statistics without gathering a group in one task.

Rows are first reduced to distinct values with counts (a combining aggregation, so a
value held by a third of all rows costs one row). Values are then cut into ranges by a
monotone formula, ranges get running offsets, and only inside a range are values sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import cut_lineage

RANGES = 1024
HEAVY = 1024  # a value held by more than one in so many rows is joined by broadcast: there are fewer of them than this


def _monotone(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def value_counts(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys, metric, value -> cnt for every value of the named columns that is a number."""
    cells = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])
    long = df.select(*keys, F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    # -0.0 and 0.0 are one value
    long = long.withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))
    return long.groupBy(*keys, "metric", "value").agg(F.count(F.lit(1)).alias("cnt"))


def with_positions(counts: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """Add `before` (rows with a smaller value) and `total` to a value-count table."""
    by = [*keys, "metric"]
    t = _monotone(F.col("value"))
    counts = cut_lineage(counts)  # read three times below
    span = counts.groupBy(*by).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    cell = F.when(
        F.col("_hi") > F.col("_lo"),
        F.least(F.floor((t - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * ranges), F.lit(ranges - 1)),
    ).otherwise(F.lit(0))
    cut = counts.join(_renamed(span, by), _same(counts, by)).withColumn("_cell", cell.cast("int"))
    cut = cut.select(*by, "value", "cnt", "_cell")
    # at most `ranges` rows per key from here to the offsets
    sizes = cut.groupBy(*by, "_cell").agg(F.sum("cnt").alias("_size"))
    order = Window.partitionBy(*by).orderBy("_cell")
    offsets = sizes.select(
        *by, "_cell",
        (F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(*by)).alias("total"),
    )
    on = [*by, "_cell"]
    placed = cut.join(_renamed(offsets, on), _same(cut, on))
    inside = Window.partitionBy(*on).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        *by, "value", "cnt",
        (F.col("_offset") + F.sum("cnt").over(inside) - F.col("cnt")).alias("before"),
        "total",
    )


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"_k_{n}" for n in names})


def _same(df: DataFrame, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"_k_{n}"))
    return cond


def percentiles(df: DataFrame, values: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, metric, p0..pk: exact percentiles with linear interpolation."""
    by = [*keys, "metric"]
    placed = with_positions(value_counts(df, keys, values), keys)
    aggs = []
    for i, p in enumerate(probs):
        at = (F.col("total") - 1) * F.lit(float(p))
        for name, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt"))
            aggs.append(F.max(F.when(holds, F.col("value"))).alias(f"_{name}{i}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_w{i}"))
    picked = placed.groupBy(*by).agg(*aggs)
    return picked.select(
        *by,
        *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(f"p{i}") for i in range(len(probs))],
    )


def percentile_row(df: DataFrame, values: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row holding <column>_p<i> for every column and probability."""
    long = percentiles(df, values, probs)
    return long.agg(*[
        F.max(F.when(F.col("metric") == v, F.col(f"p{i}"))).alias(f"{v}_p{i}")
        for v in values for i in range(len(probs))
    ])


def order_statistics(placed: DataFrame, at: dict[str, Column]) -> DataFrame:
    """metric, total and, for each named position (counted from 0), <name> and <name>_before: the value there and the rows below it.

    Positions are expressions of `total`; those outside the rows give nulls.
    """
    aggs = [F.max("total").alias("total")]
    for name, pos in at.items():
        holds = (F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt"))
        aggs += [F.max(F.when(holds, F.col(c))).alias(o) for c, o in (("value", name), ("before", f"{name}_before"))]
    return placed.groupBy("metric").agg(*aggs)


def mean_rank(df: DataFrame, value: str, out: str = "mean_rank", total: str = "n_rows") -> DataFrame:
    """Add the ascending rank (ties share their mean rank) and the row count.

    Values held by very many rows are few and are broadcast. Their rows keep out of the join of the other values: there
    they carry a mark of their own, taken from the other columns where these tell them apart, and meet nothing.
    """
    placed = cut_lineage(with_positions(value_counts(df, [], [value]), []))
    ranks = placed.select(
        F.col("value").alias("_v"),
        F.lit(0).alias("_mark"),
        (F.col("before") + (F.col("cnt") + 1) / F.lit(2.0)).alias("_rank"),
        F.col("total").alias("_total"),
        (F.col("cnt") * HEAVY > F.col("total")).alias("_heavy"),
    )
    heavy = ranks.where("_heavy").select(F.col("_v").alias("_hv"), F.col("_rank").alias("_hrank"), F.col("_total").alias("_htotal"))
    light = ranks.where("NOT _heavy").drop("_heavy")
    key = F.when(F.col(value) == 0, F.lit(0.0)).otherwise(F.col(value).cast("double"))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*plain), F.lit(HEAVY)).cast("int") + 1
    met = df.withColumn("_key", key).join(F.broadcast(heavy), F.col("_key") == F.col("_hv"), "left")
    apart = F.col("_hv").isNotNull() | F.col("_key").isNull()
    met = met.withColumns({"_at": F.when(apart, spread).otherwise(0), "_key": F.coalesce("_key", F.lit(0.0))})
    joined = met.join(light, (F.col("_key") == F.col("_v")) & (F.col("_at") == F.col("_mark")), "left")
    both = {out: F.coalesce("_hrank", "_rank"), total: F.coalesce("_htotal", "_total")}
    return joined.select(*df.columns, *[c.alias(n) for n, c in both.items()])


def row_numbers(df: DataFrame, order: Sequence[Column], out: str, within: Sequence[str] = ()) -> DataFrame:
    """row_number() over huge or skewed groups.

    Rows are range-partitioned in the wanted order and written once, so the slices stay fixed;
    a slice needs only the sizes of the slices before it.
    """
    sliced = df.repartitionByRange(*[F.col(k) for k in within], *order)
    sliced = cut_lineage(sliced.withColumn("_slice", F.spark_partition_id()))
    group = [*within, "_slice"]
    sizes = sliced.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group).orderBy(*order)
    joined = sliced.join(_renamed(offsets, group), _same(sliced, group))
    return joined.withColumn(out, (F.row_number().over(inside) + F.col("_offset")).cast("int")).drop(
        "_slice", "_offset", *[f"_k_{g}" for g in group]
    )
