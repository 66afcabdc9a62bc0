"""As-of join: to each row the values that were valid at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import last_per_key


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    *,
    slice_of_time: int = 86_400_000,
) -> DataFrame:
    """``left`` with the ``values`` of the latest row of ``right`` at or before its ``time``.

    Rows meet by ``keys``; ``time`` is a whole number in both, such as epoch milliseconds, and of
    rows of ``right`` with the same keys and time that with the largest values counts. Rows of
    ``left`` without an earlier one get NULLs, so do those with a NULL key or time.

    Time is cut into slices. Inside a slice of a key both sides are sorted together, and a row takes
    the last values before it; if there are none, it takes those that the slices before end with,
    which are found on one row per key and slice. So a hot key's rows spread over the slices it is
    active in, and no task sees all of them.
    """
    keys = [*keys]
    sliced = F.expr(f"floor(`{time}` / {slice_of_time})").alias("__slice")
    known = right.select(*keys, time, *values).dropna(subset=[*keys, time])
    known = known.select(*keys, time, sliced, F.struct(*values).alias("__seen"))
    known = known.groupBy(*keys, time, "__slice").agg(F.max("__seen").alias("__seen"))
    # what each slice begins with: one row per key and slice of either side
    ends = last_per_key(known, [*keys, "__slice"], [time]).select(*keys, "__slice", "__seen")
    asked = left.dropna(subset=[*keys, time]).select(*keys, sliced).distinct()
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        ends.unionByName(asked, allowMissingColumns=True)
        .groupBy(*keys, "__slice").agg(F.max("__seen").alias("__seen"))
        .select(*keys, "__slice", F.last("__seen", ignorenulls=True).over(before).alias("__begin"))
        .filter("__begin IS NOT NULL")
    )
    rows = left.select(*keys, time, sliced, F.struct(*left.columns).alias("__row"))
    both = rows.unionByName(known, allowMissingColumns=True)
    # at equal times what is known comes first
    inside = (
        Window.partitionBy(*keys, "__slice")
        .orderBy(F.col(time), F.col("__row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    valid = (
        both.withColumn("__valid", F.last("__seen", ignorenulls=True).over(inside))
        .filter("__row IS NOT NULL")
        .join(slices, [*keys, "__slice"], "left")
        .withColumn("__valid", F.coalesce("__valid", "__begin"))
    )
    return valid.select("__row.*", *(F.col(f"__valid.{v}").alias(v) for v in values))
