"""Joins on time and space, as equi joins on buckets, so that no plan holds a nested loop.

All take a ``by`` column (the video) that both sides share, and times in whole milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the buckets that time joins meet in.
BUCKET_MS = 10_000


def range_join(points: DataFrame, spans: DataFrame, by: str, at: str, start: str, end: str, *, end_inclusive: bool = True, bucket_ms: int = BUCKET_MS, how: str = "inner") -> DataFrame:
    """Points inside spans of the same ``by``. Columns other than ``by`` must differ. A span is listed once per bucket it touches."""
    at_bucket = F.floor(F.col(at) / bucket_ms).cast("long")
    buckets = F.sequence(F.floor(F.col(start) / bucket_ms).cast("long"), F.floor(F.col(end) / bucket_ms).cast("long"))
    left = points.withColumn("__bucket", at_bucket)
    right = spans.filter(F.col(start) <= F.col(end)).withColumn("__bucket", F.explode(buckets)).withColumnRenamed(by, "__by")
    inside = (F.col(at) >= F.col(start)) & ((F.col(at) <= F.col(end)) if end_inclusive else (F.col(at) < F.col(end)))
    return left.join(right, (F.col(by) == F.col("__by")) & (left["__bucket"] == right["__bucket"]) & inside, how).drop("__by", "__bucket")


def band_join(left: DataFrame, right: DataFrame, by: str, left_at: str, right_at: str, within_ms: int, *, strict: bool = False, how: str = "inner") -> DataFrame:
    """Pairs of the same ``by`` at most (or, strictly, less than) ``within_ms`` apart; each pair once."""
    width = max(within_ms, 1)
    a = left.withColumn("__bucket", F.floor(F.col(left_at) / width).cast("long"))
    b = right.withColumn("__home", F.floor(F.col(right_at) / width).cast("long")).withColumn("__near", F.explode(F.array(F.col("__home") - 1, F.col("__home"), F.col("__home") + 1))).drop("__home").withColumnRenamed(by, "__by")
    gap = F.abs(F.col(left_at) - F.col(right_at))
    near = gap < within_ms if strict else gap <= within_ms
    return a.join(b, (F.col(by) == F.col("__by")) & (F.col("__bucket") == F.col("__near")) & near, how).drop("__by", "__bucket", "__near")


def nearest_within(left: DataFrame, right: DataFrame, by: str, key: list[str], left_at: str, right_at: str, order: list[str], within_ms: int, take: list[str], *, strict: bool = False) -> DataFrame:
    """Every left row with ``take`` of the nearest right row in the band, nulls if none; ties go to the first by ``order``.

    ``key`` names a left row. The minimum is taken by a group-by, so no candidate list is gathered or sorted.
    """
    gap = F.abs(F.col(left_at) - F.col(right_at))
    best = band_join(left.select(by, *[k for k in key if k != by], left_at), right.select(by, right_at, *order, *[t for t in take if t not in order and t != right_at]), by, left_at, right_at, within_ms, strict=strict).groupBy(by, *[k for k in key if k != by]).agg(
        F.min_by(F.struct(*[F.col(t) for t in take]), F.struct(gap, *[F.col(o) for o in order])).alias("__best")
    )
    return left.join(best, [by, *[k for k in key if k != by]], "left").select("*", *[F.col(f"__best.{t}").alias(f"near_{t}") for t in take]).drop("__best")


def nearest(left: DataFrame, right: DataFrame, by: str, key: list[str], left_at: str, right_at: str, order: str, take: list[str]) -> DataFrame:
    """Every left row with ``take`` of the nearest right row of the same ``by`` at any distance.

    One pass over both sides in time order: the last right row at or before, and the first at or after.
    Of right rows at one time the smallest ``order`` counts; of two as near, the smaller ``order``.
    """
    pack = F.struct(F.col(right_at).alias("at"), F.col(order).alias("seq"), *[F.col(t).alias(f"t_{t}") for t in take])
    first = right.groupBy(by, right_at).agg(F.min_by(pack, order).alias("__right")).select(by, F.col(right_at).alias("__at"), "__right")
    both = left.withColumn("__at", F.col(left_at)).unionByName(first, allowMissingColumns=True)
    timeline = Window.partitionBy(by).orderBy("__at")
    before = F.last("__right", ignorenulls=True).over(timeline.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("__right", ignorenulls=True).over(timeline.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    found = both.withColumns({"__before": before, "__after": after}).filter(F.col("__right").isNull())
    gap = lambda c: F.abs(F.col(f"{c}.at") - F.col(left_at))
    use_after = F.col("__before").isNull() | (F.col("__after").isNotNull() & ((gap("__after") < gap("__before")) | ((gap("__after") == gap("__before")) & (F.col("__after.seq") < F.col("__before.seq")))))
    best = F.when(use_after, F.col("__after")).otherwise(F.col("__before"))
    return found.withColumn("__best", best).select(*left.columns, *[F.col(f"__best.t_{t}").alias(f"near_{t}") for t in take])


def iou(a: str, b: str) -> Column:
    """Overlap of two boxes [x, y, w, h], given as column-name prefixes; 0 for boxes without area."""
    p = lambda s, c: F.col(f"{s}{c}")
    width = F.greatest(F.lit(0.0), F.least(p(a, "x") + p(a, "w"), p(b, "x") + p(b, "w")) - F.greatest(p(a, "x"), p(b, "x")))
    height = F.greatest(F.lit(0.0), F.least(p(a, "y") + p(a, "h"), p(b, "y") + p(b, "h")) - F.greatest(p(a, "y"), p(b, "y")))
    union = p(a, "w") * p(a, "h") + p(b, "w") * p(b, "h") - width * height
    return F.when(union > 0, width * height / union).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two float arrays, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def covering_spans(spans: DataFrame, by: str, start: str, end: str, at_start: Column, at_end: Column) -> DataFrame:
    """Spans that overlap [at_start, at_end], ends included; both are columns of ``spans``."""
    return spans.filter((F.col(start) <= at_end) & (F.col(end) >= at_start))
