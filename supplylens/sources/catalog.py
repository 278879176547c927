"""Tables by name: queries, listings and database connections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL; ``frames`` are referred to as {name} in the text."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)


def list_tables(spark: SparkSession, pattern: str | None = None) -> list[str]:
    """Names of all tables and views, or of those that fit a pattern such as ``stock_*``."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def list_columns(df: DataFrame, table: str) -> DataFrame:
    """Name and type of every column of a table."""
    cells = F.array(
        *[
            F.struct(
                F.lit(table).alias("TableName"),
                F.lit(c).alias("ColumnName"),
                F.lit(t).alias("DataType"),
            )
            for c, t in df.dtypes
        ]
    )
    return df.sparkSession.range(1).select(F.explode(cells).alias("c")).select("c.*")


def row_counts(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Row count of every table."""
    out = None
    for name, df in tables:
        row = df.agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("Rows"))
        out = row if out is None else out.unionByName(row)
    return out


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Scan a database table, in ranges of a numeric column when one is named."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch, **options).mode(
        "overwrite"
    ).save()
