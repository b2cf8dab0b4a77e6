"""A stand-in row for a grouped result that would be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_sums_or_default(parts: DataFrame, key: str, sums: list[str], default_key: object) -> DataFrame:
    """Sums per key of already counted rows; one zero row for ``default_key`` when there are none.

    Each row of ``parts`` holds partial sums, the first a row count above zero. A zero
    row without key is added and a grand total taken in the same grouping: the total
    is zero exactly when there was no other row. So the result is built in one
    shuffle, with no action on the driver and no second run of the input.
    """
    spark = parts.sparkSession
    zero = spark.range(1, numPartitions=1).select(
        F.lit(None).cast(parts.schema[key].dataType).alias(key),
        *[F.lit(0).cast(parts.schema[c].dataType).alias(c) for c in sums],
    )
    rows = parts.filter(F.col(key).isNotNull()).select(key, *sums).unionByName(zero)
    totals = rows.rollup(key).agg(*[F.sum(c).alias(c) for c in sums], F.grouping(key).alias("_total"))
    is_total = F.col("_total") == 1
    kept = totals.filter((is_total & (F.col(sums[0]) == 0)) | (~is_total & F.col(key).isNotNull()))
    default = F.lit(default_key).cast(parts.schema[key].dataType)
    return kept.select(F.when(is_total, default).otherwise(F.col(key)).alias(key), *sums)
