"""Catalog tables: create, list, append, read and drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def create_table(spark: SparkSession, name: str, columns: dict[str, str]) -> bool:
    """Create an empty table; an ``id`` column is added when missing. False when it already exists."""
    if spark.catalog.tableExists(name):
        return False
    fields = dict(columns)
    fields.setdefault("id", "int")
    schema = ", ".join(f"`{column}` {kind}" for column, kind in fields.items())
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return True


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


def drop_table(spark: SparkSession, name: str) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    spark.sql(f"DROP TABLE {name}")
    return True


def append_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append by column name; columns the rows lack stay null, unknown columns are an error."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    target = spark.table(name).schema
    unknown = set(rows.columns) - set(target.names)
    if unknown:
        raise ValueError(f"table {name} has no column {sorted(unknown)}")
    cells = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    rows.select(*cells).write.insertInto(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
