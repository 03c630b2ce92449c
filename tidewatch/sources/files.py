"""File and table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sinks.files import TIMESTAMP_FORMAT


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema (no inference pass)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def read_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("timestampNTZFormat", TIMESTAMP_FORMAT).json(path)


def read_ordered(
    table: DataFrame, order_by: list[str], max_rows: int | None = None
) -> DataFrame:
    """Table in key order, optionally only its first ``max_rows`` rows.

    With a cap Spark keeps the smallest rows per task and merges those, so the
    table is never sorted as a whole.
    """
    ordered = table.orderBy(*order_by)
    return ordered if max_rows is None else ordered.limit(max_rows)


def first_rows(table: DataFrame, order_by: list[str], count: int) -> DataFrame:
    return table.orderBy(*order_by).limit(count)


def last_rows(table: DataFrame, order_by: list[str], count: int) -> DataFrame:
    return table.orderBy(*[F.col(name).desc() for name in order_by]).limit(count)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, time_column: str = "observed_at"
) -> None:
    """Create a Parquet table partitioned by observation date, if it is absent.

    Parquet tables enforce no keys. :func:`tidewatch.operators.joins.assert_unique`
    and :func:`tidewatch.operators.contracts.assert_not_null` check them instead.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, observed_date DATE) "
        f"USING parquet PARTITIONED BY (observed_date) "
        f"COMMENT 'observed_date is the date of {time_column}'"
    )
