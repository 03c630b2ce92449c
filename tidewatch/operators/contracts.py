"""Checks on column names and values that come before any expensive work."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.schemas import (
    FEATURE_COLUMNS,
    FORBIDDEN_TARGET_COLUMNS,
    LEAKAGE_COLUMNS,
    TARGET_COLUMN,
)


class ContractError(ValueError):
    """A frame does not fit the declared contract."""


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ContractError(f"{what} lacks columns: {', '.join(absent)}")


def check_feature_frame(df: DataFrame, keys: list[str] | None = None) -> None:
    """Contract of the feature table: all columns, in order, no future labels."""
    future = [name for name in FORBIDDEN_TARGET_COLUMNS if name in df.columns]
    if future:
        raise ContractError(f"feature frame holds future labels: {', '.join(future)}")
    require_columns(df, FEATURE_COLUMNS, "feature frame")
    if df.columns != [*(keys or []), *FEATURE_COLUMNS]:
        raise ContractError("feature frame columns are not in contract order")


def check_training_contract(features: list[str], target: str = TARGET_COLUMN) -> None:
    """The target is fixed and no model input may reveal it."""
    if target != TARGET_COLUMN:
        raise ContractError(f"the training target must be {TARGET_COLUMN}")
    leaked = [name for name in LEAKAGE_COLUMNS if name in features]
    if leaked:
        raise ContractError(f"model inputs reveal the label: {', '.join(leaked)}")


def select_contract(
    df: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    require_columns(df, columns, "frame")
    return df.select(*(keys or []), *columns)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ContractError(message)
    return df


def assert_not_null(df: DataFrame, names: list[str]) -> DataFrame:
    missing = reduce(or_, [F.col(name).isNull() for name in names])
    if not df.where(missing).isEmpty():
        raise ContractError(f"NULL in a required column of {', '.join(names)}")
    return df
