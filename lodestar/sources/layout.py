"""Table layouts and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import dealt, heavy_keys, repeated, salt_table
from ..session import scratch_path


def partition_marker(df: DataFrame, predicate: Column, name: str, hi: int, lo: int) -> DataFrame:
    """Adds a two-valued column to partition by: ``hi`` where the predicate holds, else ``lo``."""
    return df.withColumn(name, F.when(predicate, F.lit(hi)).otherwise(F.lit(lo)))


def write_partitioned(df: DataFrame, path: str, cols: list[str]) -> None:
    """Parquet, one folder per value.

    Rows are rebalanced by value: adaptive execution splits a value that holds a large
    share of the rows over several tasks and puts small values together in one.
    """
    df.hint("rebalance", *cols).write.partitionBy(*cols).parquet(path)


def insert_static_partition(df: DataFrame, table: str, partition: dict[str, int]) -> None:
    """``INSERT INTO table PARTITION (name = value)`` of all rows."""
    clause = ", ".join(f"{name} = {int(value)}" for name, value in partition.items())
    df.sparkSession.sql(f"INSERT INTO {table} PARTITION ({clause}) SELECT * FROM {{rows}}", rows=df)


def insert_dynamic_partitions(df: DataFrame, table: str, cols: list[str]) -> None:
    """Insert into a partitioned table; each row's values say which partition it goes to.

    Balanced as in ``write_partitioned``. The table has its partition columns last.
    """
    first = [c for c in df.columns if c not in cols]
    df.select(*first, *cols).hint("rebalance", *cols).write.insertInto(table)


def collect_statistics(spark: SparkSession, table: str, cols: list[str] | None = None) -> None:
    """Table and column statistics for the cost-based optimizer, all columns by default."""
    which = f"COLUMNS {', '.join(cols)}" if cols else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")


def create_partitioned_table(spark: SparkSession, table: str, columns: str, partition: str) -> None:
    """Parquet table below the shared folder, partitioned by one of its columns."""
    location = scratch_path(spark, table)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet "
              f"PARTITIONED BY ({partition}) LOCATION '{location}'")


def write_bucketed(df: DataFrame, table: str, col: str | list[str], n: int,
                   partition_cols: list[str] | None = None) -> DataFrame:
    """Managed layout: ``n`` buckets on ``col``, sorted inside, optionally partitioned too.

    Rows are hashed to the buckets before writing, which gives one file per bucket.
    Tables bucketed alike join on ``col`` without a shuffle.
    """
    spark = df.sparkSession
    cols = [col] if isinstance(col, str) else col
    writer = (df.repartition(n, *cols).write.bucketBy(n, *cols).sortBy(*cols).format("parquet")
              .option("path", scratch_path(spark, table)))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(table)
    return spark.table(table)


def write_bucketed_pair(left: DataFrame, right: DataFrame, on: list[str], n: int, names: tuple[str, str, str],
                        spread_by: list[str], partition_cols: list[str] | None = None,
                        hot: dict[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables in equal buckets that join without a shuffle, whatever the skew of the key in ``left``.

    Buckets have two levels, the key and a salt. Only a hot key of ``left`` has salts above 0: its rows
    lie in as many buckets as they would fill, and its one row of ``right`` in each of these. Which keys
    have how many is kept in the layout table, the last of ``names``, so rows that come later can be
    dealt alike. Join on ``[*on, "salt"]``. The layout is the same at every size; without hot keys the
    layout table is empty. ``left`` may be partitioned too.
    """
    spark = left.sparkSession
    found = heavy_keys(left, on) if hot is None else hot
    path = scratch_path(spark, names[2])
    salt_table(spark, found).coalesce(1).write.option("path", path).saveAsTable(names[2])
    table = spark.table(names[2])
    keys = [*on, "salt"]
    return (write_bucketed(dealt(left, on, table, spread_by), names[0], keys, n, partition_cols),
            write_bucketed(repeated(right, on, table), names[1], keys, n))


def replace_table(df: DataFrame, table: str) -> DataFrame:
    """``df`` as the new content of ``table``, made if it is missing.

    Rows are written to a folder of their own first; then one catalog call points the table at it. A
    reader that has planned its query goes on with the old files, a later one gets the new ones,
    nobody a mixture; if writing fails the table is as before. Columns must stay the same, since a
    table with others is another table.
    """
    spark = df.sparkSession
    location = scratch_path(spark, table)
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").option("path", location).saveAsTable(table)
        return spark.table(table)
    now = [(f.name, f.dataType) for f in spark.table(table).schema]
    if now != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns: {now}")
    df.write.parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """Takes a table out of the catalog, if it is there. Its files stay for readers that have begun."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_lines(df: DataFrame, path: str) -> None:
    """One text line per row of a single string column."""
    df.write.text(path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.options(header=True, **options).csv(path)
