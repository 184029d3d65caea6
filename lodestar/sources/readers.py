"""File sources with explicit schemas: no inference pass, bad cells set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("reviewText", T.StringType()),
])

# Per-term record of document counts inside and outside a category.
TERM_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("num_docs_in_category", T.LongType()),
    T.StructField("num_docs_in_category_without", T.LongType()),
    T.StructField("num_docs", T.LongType()),
    T.StructField("num_docs_without", T.LongType()),
])

CORRUPT = "_corrupt"


def read_reviews(spark: SparkSession, path: str | list[str],
                 schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """JSON lines; only the fields of the schema are parsed."""
    return spark.read.schema(schema).json(path)


def read_csv_typed(spark: SparkSession, paths: str | list[str], schema: T.StructType,
                   timestamp_format: str | None = None, date_format: str | None = None,
                   multi_line: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """CSV files with a header line, as one typed input.

    Quoted separators and line breaks stay inside their cell and a cell that does not
    fit its type is null. ``keep_corrupt`` adds the raw text of such rows in a column
    that ``split_corrupt`` uses. ``multi_line`` is needed where cells hold line breaks; it reads
    a file in one task.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("multiLine", multi_line).option("escape", '"')
              .option("enforceSchema", True))
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(paths)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and the rows set aside with their raw text."""
    return (df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()))


def decode_terms(json_col: Column) -> Column:
    """Struct of a term record that was stored as JSON text."""
    return F.from_json(json_col, TERM_SCHEMA)
