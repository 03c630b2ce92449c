"""File sinks."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame

from tidewatch.session import materialize

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_json_document(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def write_snapshot(df: DataFrame, root: str, now: datetime | None = None) -> dict[str, str]:
    """Write ``run=<epoch second>/`` and overwrite ``latest/`` with the same rows.

    The rows are computed once: ``latest`` is copied from a written table.
    """
    rows = materialize(df, "snapshot")
    second = int((now or datetime.now(tz=UTC)).timestamp())
    paths = {"run": f"{root}/run={second}", "latest": f"{root}/latest"}
    for path in paths.values():
        write_csv(rows, path)
    return paths
