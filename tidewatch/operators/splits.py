"""Time-ordered validation splits, label encoding and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.contracts import ContractError
from tidewatch.operators.prefix import with_row_index
from tidewatch.operators.sizing import broadcast_if_small
from tidewatch.schemas import TARGET_COLUMN, VALIDATION_GAP_ROWS


def holdout_split(
    df: DataFrame,
    keys: list[str] | None = None,
    *,
    test_fraction: float = 0.2,
    gap: int = VALIDATION_GAP_ROWS,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Add ``row_index``, ``n_rows`` and ``split``.

    The last share of each series is ``test``, rows up to ``gap`` rows before it
    are ``train``, the rows in between are ``gap``.
    """
    if not 0 < test_fraction < 1:
        raise ContractError("test_fraction must lie between 0 and 1")
    indexed = with_row_index(df, keys or [], order_by, count="n_rows")
    first_test = _share(F.col("n_rows"), test_fraction)
    return indexed.withColumn(
        "split",
        F.when(F.col("row_index") >= first_test, "test")
        .when(F.col("row_index") < first_test - gap, "train")
        .otherwise("gap"),
    )


def _share(count: Column, test_fraction: float) -> Column:
    return F.floor(count * F.lit(1 - test_fraction))


def check_holdout(
    split: DataFrame, keys: list[str] | None = None, *, cv_splits: int = 3,
    gap: int = VALIDATION_GAP_ROWS,
) -> None:
    """Raise where a series is too short for the holdout or for its folds."""
    if cv_splits < 2:
        raise ContractError("cv_splits must be at least 2")
    sizes = split.groupBy(*(keys or [])).agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )
    fold = F.floor(F.col("train") / (cv_splits + 1))
    short = sizes.where(
        (F.col("train") <= 0)
        | (F.col("test") <= 0)
        | (fold < 1)
        | (F.col("train") - gap - fold * cv_splits <= 0)
    )
    bad = short.limit(1).collect()
    if bad:
        raise ContractError(f"too few rows for a holdout with a gap: {bad[0].asDict()}")


def expanding_folds(
    train: DataFrame,
    keys: list[str] | None = None,
    *,
    folds: int = 3,
    gap: int = VALIDATION_GAP_ROWS,
    index: str = "row_index",
    count: str = "n_train",
) -> DataFrame:
    """One row per (row, fold) with ``fold`` and ``role`` (train or validation).

    ``index`` is the position inside the training part and ``count`` its size.
    Each fold validates on the next equal slice and trains on all rows that lie
    at least ``gap`` rows before it. The fan-out is ``folds``, a small constant.
    """
    if folds < 2:
        raise ContractError("folds must be at least 2")
    size = F.floor(F.col(count) / (folds + 1))
    start = F.col(count) - (F.lit(folds + 1) - F.col("fold")) * size
    position = F.col(index)
    return (
        train.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(1, folds + 1)])))
        .withColumn(
            "role",
            F.when((position >= start) & (position < start + size), "validation").when(
                position < start - gap, "train"
            ),
        )
        .where(F.col("role").isNotNull())
    )


def training_part(split: DataFrame, keys: list[str] | None = None,
                  *, test_fraction: float = 0.2, gap: int = VALIDATION_GAP_ROWS) -> DataFrame:
    """Training rows of a holdout with ``n_train``; positions stay valid."""
    size = _share(F.col("n_rows"), test_fraction) - gap
    return split.where(F.col("split") == "train").withColumn("n_train", size)


def label_index(df: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Distinct labels with their alphabetical position, from 0.

    Only the distinct labels are ordered, after the aggregate has reduced them.
    """
    labels = df.select(F.col(label).cast("string").alias("label")).distinct()
    order = Window.partitionBy(F.lit(0)).orderBy("label")
    return labels.select("label", (F.row_number().over(order) - 1).alias("label_index"))


def encode_labels(df: DataFrame, labels: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Add ``label_index`` to every row; a row without a label meets the NULL label."""
    named = broadcast_if_small(labels.withColumnRenamed("label", "__label"))
    return df.join(named, F.col(label).eqNullSafe(F.col("__label")), "left").select(
        *df.columns, "label_index"
    )


def class_weight_table(df: DataFrame, label: str, power: float = 0.5) -> DataFrame:
    """Weight per class: (rows / (classes * rows of the class)) ** power."""
    if power < 0:
        raise ContractError("the class weight power must not be negative")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    everything = Window.partitionBy(F.lit(0))
    balanced = F.sum("class_rows").over(everything) / (
        F.count(F.lit(1)).over(everything) * F.col("class_rows")
    )
    return counts.select(label, "class_rows", F.pow(balanced, F.lit(power)).alias("class_weight"))


def class_weights(df: DataFrame, label: str = TARGET_COLUMN, power: float = 0.5) -> DataFrame:
    """Add ``class_weight`` to every row; rows without a label are a class of their own."""
    table = class_weight_table(df, label, power).drop("class_rows")
    named = broadcast_if_small(table.withColumnRenamed(label, "__label"))
    return df.join(named, F.col(label).eqNullSafe(F.col("__label"))).select(
        *df.columns, "class_weight"
    )
