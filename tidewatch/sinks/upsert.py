"""Upsert by key on plain Parquet tables.

The merge itself is a full outer join on the unique key. A partitioned table is
only rewritten in the date partitions that the incoming rows touch.
"""

from __future__ import annotations

import functools
import json
import operator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.contracts import ContractError
from tidewatch.operators.sizing import at_most

PARTITION = "observed_date"
SCHEMA_FILE = "_columns.json"
MANY_DATES = 20_000
# Columns that an update leaves alone, besides the key itself.
KEPT_ON_UPDATE = ("id", "inserted_at", "generated_at")


def merge_keep_id(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys; on a known key update all table columns except the id and
    the creation times. A table column that was not sent is set to NULL."""

    def updated(name: str) -> Column:
        if name in KEPT_ON_UPDATE:
            return F.col(f"t.{name}")
        return _sent(target, incoming, name)

    return _merge(target, incoming, keys, updated)


def merge_replace(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys; on a known key replace every sent column, keep the rest."""

    def updated(name: str) -> Column:
        return _sent(target, incoming, name) if name in incoming.columns else F.col(f"t.{name}")

    return _merge(target, incoming, keys, updated)


MODES = {"keep_id": merge_keep_id, "replace": merge_replace}


def _sent(target: DataFrame, incoming: DataFrame, name: str) -> Column:
    kind = target.schema[name].dataType
    return F.col(f"s.{name}").cast(kind) if name in incoming.columns else F.lit(None).cast(kind)


def _merge(target, incoming, keys, updated) -> DataFrame:
    extra = [name for name in incoming.columns if name not in target.columns]
    if extra:
        raise ContractError(f"the table has no columns {', '.join(extra)}")
    left = target.withColumn("__old", F.lit(True)).alias("t")
    right = incoming.withColumn("__new", F.lit(True)).alias("s")
    on = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]
    is_old, is_new = F.col("t.__old").isNotNull(), F.col("s.__new").isNotNull()
    columns = []
    for name in target.columns:
        if name in keys:
            value = F.coalesce(f"t.{name}", f"s.{name}")
        else:
            value = (
                F.when(is_old & is_new, updated(name))
                .when(is_new, _sent(target, incoming, name))
                .otherwise(F.col(f"t.{name}"))
            )
        columns.append(value.alias(name))
    return left.join(right, on, "full_outer").select(*columns)


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's absent columns as typed NULLs, behind the present ones."""
    absent = {
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns
    }
    return df.withColumns(absent) if absent else df


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str],
    *,
    mode: str = "replace",
    schema: T.StructType | None = None,
    time: str = "observed_at",
) -> int:
    """Upsert into the Parquet table at ``path``; returns the number of rows sent.

    The table keeps its stored columns, whatever was sent; ``schema`` (by default the
    sent columns) adds those that it lacks. Keys and times must not be NULL, and keys
    must be unique in ``incoming`` (see ``keep_last``); both are checked first. Only touched date
    partitions are read and rewritten, in one job that reads the old files before
    its commit replaces them, so a lost executor only repeats tasks. A repeated
    upsert of the same rows changes nothing. Rows are rebalanced by date before
    the write: large dates are split over several files, small ones merged.
    """
    if mode not in MODES:
        raise ContractError(f"unknown upsert mode {mode!r}; use one of {', '.join(MODES)}")
    dated = incoming.withColumn(PARTITION, F.to_date(time)).persist()
    try:
        known = _checked(dated, list(dict.fromkeys([*keys, time])), keys)
        if known.rows:
            _rewrite(spark, path, dated, keys, MODES[mode], schema or incoming.schema, time, known)
        return known.rows
    finally:
        dated.unpersist()


def _checked(dated: DataFrame, needed: list[str], keys: list[str]) -> Row:
    """Rows, dates and their range, after an error for missing or repeated keys.

    One aggregate by key answers all of it, so the batch is computed once.
    """
    absent = functools.reduce(operator.or_, [F.col(name).isNull() for name in needed])
    by_key = dated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(absent).alias("absent"),
        F.min(PARTITION).alias("first"), F.max(PARTITION).alias("last"),
    )
    known = by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("absent"), F.lit(0)).alias("absent"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.min("first").alias("first"), F.max("last").alias("last"),
    ).first()
    if known.absent:
        raise ContractError(f"{known.absent} rows have a NULL in {', '.join(needed)}")
    if known.repeated:
        raise ContractError(f"{known.repeated} keys ({', '.join(keys)}) are sent more than once")
    return known


def _rewrite(spark, path, dated, keys, merge, schema, time, known) -> None:
    """Merge the batch into the partitions of its dates.

    The dates are a static partition filter: a late hour of long ago beside today's
    does not read what lies between. Only a batch of more than MANY_DATES dates (over
    fifty years of days) is pruned by its range, with the dates joined.
    """
    table_schema = _table_schema(spark, path, schema)
    dates = dated.select(PARTITION).distinct()
    old = read_table(spark, path, table_schema).where(F.col(PARTITION).between(known.first, known.last))
    if at_most(dates, MANY_DATES):
        old = old.where(F.col(PARTITION).isin([row[0] for row in dates.collect()]))
    else:
        old = old.join(dates, PARTITION, "left_semi")
    merged = merge(old.select(*table_schema.names), dated, keys)
    (
        merged.withColumn(PARTITION, F.to_date(time))
        .hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    spark.catalog.refreshByPath(path)


def _table_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Columns of the stored table and those of ``schema`` that it lacks.

    They are kept in one small file beside the data, so no data file is opened for
    them. A table without that file is asked once. A new table is created empty.
    """
    stored, known = _stored_schema(spark, path)
    partition = T.StructField(PARTITION, T.DateType(), True)
    types = {f.name: f.dataType for f in stored.fields} if stored else {}
    fields = [
        T.StructField(f.name, types.get(f.name, f.dataType), True)
        for f in schema.fields if f.name != PARTITION
    ]
    sent = {f.name for f in fields}
    kept = [
        T.StructField(f.name, f.dataType, True)
        for f in (stored.fields if stored else []) if f.name not in {*sent, PARTITION}
    ]
    whole = T.StructType([*fields, *kept, partition])
    if stored is None:
        spark.createDataFrame([], whole).write.mode("ignore").partitionBy(PARTITION).parquet(path)
    if not known or {f.name for f in stored.fields} != set(whole.names):
        _store_schema(spark, path, whole)
    return whole


def _schema_file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_FILE}")
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def _stored_schema(spark: SparkSession, path: str) -> tuple[T.StructType | None, bool]:
    """The table's columns, if there is a table, and whether its file named them."""
    file, system = _schema_file(spark, path)
    if system.exists(file):
        stream = system.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(text)), True
    if not system.exists(file.getParent()):
        return None, False
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema, False
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return T.StructType([]), False  # a table without files


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    file, system = _schema_file(spark, path)
    stream = system.create(file, True)
    try:
        stream.write(schema.json().encode())
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
