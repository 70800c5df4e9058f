"""Points in spans, joined by shared cut points instead of a nested loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges that the line of points is cut into; a span is copied only to the ranges it crosses.
RANGES = 256


def cut_points(points: DataFrame, point: str, ranges: int = RANGES) -> list:
    """Bounds that deal the points into about equal ranges, at most ``ranges`` - 1 values whatever the number of points."""
    place = F.col(point).cast("double") if dict(points.dtypes)[point] not in ("date", "timestamp") else F.unix_timestamp(F.col(point).cast("timestamp")).cast("double")
    shares = [i / ranges for i in range(1, ranges)]
    found = points.where(F.col(point).isNotNull()).agg(F.percentile_approx(place, shares, 10_000)).first()[0]
    return sorted(set(found or []))


def points_in_spans(points: DataFrame, spans: DataFrame, point: str, start: str, end: str, keys: Sequence[str] = (), ranges: int = RANGES) -> DataFrame:
    """Rows of both sides where ``start`` <= ``point`` < ``end``; a NULL end is open, a NULL start or point meets nothing.

    Both sides are cut at the same bounds, taken from quantiles of the points. A point lies in one range; a span is copied to
    the ranges from its start to its end. The join is then an equality of (keys, range), so it is a shuffle that Spark can split
    when skewed, and no side needs to be small. Column names other than the keys must differ.
    """
    cuts = cut_points(points, point, ranges)
    seconds = lambda df, c: F.col(c).cast("double") if dict(df.dtypes)[c] not in ("date", "timestamp") else F.unix_timestamp(F.col(c).cast("timestamp")).cast("double")
    bounds = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    # Number of bounds below a place. (No lambda: Spark 4.1 loses its variable when it infers filters from a join on the result.)
    slot = lambda place: (F.array_position(F.sort_array(F.array_append(bounds, place)), place) - 1).cast("int")
    left = points.where(F.col(point).isNotNull()).withColumn("_range", slot(seconds(points, point)))
    last = F.when(F.col(end).isNull(), F.lit(len(cuts))).otherwise(slot(seconds(spans, end)))
    usable = spans.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    right = usable.withColumn("_range", F.explode(F.sequence(slot(seconds(spans, start)), last)))
    inside = (F.col(start) <= F.col(point)) & (F.col(end).isNull() | (F.col(point) < F.col(end)))
    return left.join(right, [*keys, "_range"]).where(inside).drop("_range")
