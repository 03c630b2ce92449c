"""Scaling of sequence inputs, fitted on the training windows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.prefix import with_row_index


def window_weights(
    df: DataFrame, keys: list[str], *, length: int = 24, test_fraction: float = 0.2
) -> DataFrame:
    """Add ``row_index``, ``n_rows`` and ``weight``: in how many training windows
    a row lies.

    A window for the row at position t holds the ``length`` rows before t. The
    first share of the windows of each series is for training.
    """
    indexed = with_row_index(df, keys, count="n_rows")
    first = F.lit(length)
    end = first + F.floor((F.col("n_rows") - length) * F.lit(1 - test_fraction))
    low = F.greatest(F.col("row_index") + 1, first)
    high = F.least(F.col("row_index") + length, end - 1)
    return indexed.withColumn("weight", F.greatest(high - low + 1, F.lit(0)))


def window_scaler(
    df: DataFrame,
    keys: list[str],
    features: list[str],
    *,
    length: int = 24,
    test_fraction: float = 0.2,
) -> DataFrame:
    """``feature, mean, scale`` over all values of all training windows.

    Windows overlap, so a row counts once per window that holds it. Weighted sums
    give that without building the windows. ``scale`` is the population deviation,
    1 for a constant feature.
    """
    weighted = window_weights(
        df.select(*keys, "observed_at", *features), keys, length=length, test_fraction=test_fraction
    ).where("weight > 0")
    return weighted_moments(weighted, features)


def weighted_moments(weighted: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population deviation per feature, rows counted ``weight`` times.

    Values are shifted by the feature's plain mean first, because sums of squares
    of large, close values lose their digits.
    """
    shift = weighted.agg(*[F.avg(name).alias(name) for name in features]).first()
    centred = weighted.select(
        "weight",
        *[
            (F.col(name).cast("double") - F.lit(float(shift[name] or 0.0))).alias(name)
            for name in features
        ],
    )
    w = F.col("weight")
    sums = centred.agg(
        F.sum("weight").alias("w"),
        *[F.sum(w * F.col(name)).alias(f"s_{name}") for name in features],
        *[F.sum(w * F.col(name) * F.col(name)).alias(f"q_{name}") for name in features],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                (F.lit(float(shift[name] or 0.0)) + F.col(f"s_{name}") / F.col("w")).alias("mean"),
                F.sqrt(
                    F.greatest(
                        F.col(f"q_{name}") / F.col("w")
                        - F.pow(F.col(f"s_{name}") / F.col("w"), F.lit(2.0)),
                        F.lit(0.0),
                    )
                ).alias("scale"),
            )
            for name in features
        ]
    )
    return sums.select(F.inline(rows)).withColumn(
        "scale", F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale"))
    )
