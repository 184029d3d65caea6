"""CSV files with line breaks inside cells, read by many tasks.

Spark's own reader gives such a file to one task, because whether a line break ends a row depends on all
quotes before it. Here the file is read twice as plain lines, in ranges of bytes like any text. The
first pass counts the quotes of every range. Their parity, summed over the ranges before, says
whether a range begins inside a cell; so the second pass knows of each line whether it begins a row. Lines
inside cells are put together by a shuffle of those lines alone, and rows are parsed by ``from_csv``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import checked_broadcast
from .readers import CORRUPT

_LINES = "file long, start long, place long, odd boolean, value string"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, start, value): every line with its file, as a hash, and the first byte of its range."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _open_ranges(lines: DataFrame, quote: str) -> DataFrame:
    """(file, start, inside): whether a range of bytes begins inside a cell. A row per range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote)))
    each = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _numbered(quote: str):
    """Lines with their place in the range and whether an odd number of quotes of the range stands before."""
    def run(batches):
        now, place, quotes = None, 0, 0
        for batch in batches:
            file, start = (batch.column(c).to_numpy() for c in (0, 1))
            found = pc.count_substring(batch.column(2), quote).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            places, odd = np.empty(len(file), np.int64), np.empty(len(file), bool)
            for a, b in zip([0, *cuts], [*cuts, len(file)]):
                if a == b:
                    continue
                if now != (file[a], start[a]):
                    now, place, quotes = (file[a], start[a]), 0, 0
                places[a:b] = np.arange(place, place + b - a)
                sums = quotes + np.cumsum(found[a:b])
                odd[a:b] = (sums - found[a:b]) % 2 == 1
                place, quotes = place + b - a, int(sums[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(places), pa.array(odd), batch.column(2)],
                names=["file", "start", "place", "odd", "value"])
    return run


def row_texts(spark: SparkSession, paths: str | list[str], quote: str = '"') -> DataFrame:
    """(first, text): every row's text as it stands in the files, header lines left out.

    ``first`` is true for a file's first row. Line breaks inside quotes stay as they are, a carriage return
    before a row's end goes. A file that ends inside quotes gives what is left as its last row. Empty
    lines between rows are no rows. Quotes inside a cell have to be doubled.
    """
    lines = _lines(spark, paths)
    ranges, _ = checked_broadcast(_open_ranges(lines, quote))
    placed = lines.mapInArrow(_numbered(quote), _LINES).join(ranges, ["file", "start"], "left")
    # the ranges of both passes are the same split of the same files; anything else must not pass unseen
    inside = F.when(F.col("inside").isNull(), F.raise_error(F.lit("the files changed while they were read"))
                    ).otherwise(F.col("inside") != F.col("odd")).cast("boolean")
    told = placed.withColumn("middle", inside).drop("inside", "odd")
    at = F.struct("start", "place")
    # rows of several lines: those with a middle line, and the line before the first of these
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote)))
    opens = (F.col("middle").cast("int") + quotes) % 2 == 1
    single = told.where(~F.col("middle") & ~opens).select(at.alias("at"), "value")
    part = told.where(F.col("middle") | opens)
    # a row's number within its range; lines before the range's first row belong to an earlier range
    inner = Window.partitionBy("file", "start").orderBy("place")
    counted = part.withColumn("row", F.max(F.when(~F.col("middle"), F.col("place"))).over(inner))
    begun = counted.groupBy("file", "start").agg(F.max("row").alias("last_row"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carried = begun.select("file", "start", F.last(F.when(F.col("last_row").isNotNull(), F.struct(
        F.col("start").alias("start"), F.col("last_row").alias("row"))), True).over(earlier).alias("open"))
    owners, _ = checked_broadcast(carried)
    owner = F.coalesce(F.when(F.col("row").isNotNull(), F.struct("start", "row")), F.col("open"))
    several = (counted.join(owners, ["file", "start"]).withColumn("owner", owner).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("lines"))
        .select(F.struct(F.col("owner.start").alias("start"), F.col("owner.row").alias("place")).alias("at"),
                F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value")))
    text = F.regexp_replace("value", "\r$", "")
    return (single.unionAll(several)
            .select(((F.col("at.start") == 0) & (F.col("at.place") == 0)).alias("first"), text.alias("text"))
            .where(F.col("first") | (F.col("text") != "")))


def read_csv_ranges(spark: SparkSession, paths: str | list[str], schema: T.StructType,
                    keep_corrupt: bool = False, **options: str) -> DataFrame:
    """Typed rows of CSV files with a header line; as ``read_csv_typed`` with ``multi_line``, in many tasks.

    ``keep_corrupt`` adds the raw text of rows with a cell that does not fit its type or with other than
    the wanted number of cells, for ``split_corrupt``.
    """
    rows = row_texts(spark, paths).where("not first")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    settings = {"mode": "PERMISSIVE", "escape": '"', "columnNameOfCorruptRecord": CORRUPT, **options}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.fields)
    parsed = rows.select(F.from_csv("text", ddl, settings).alias("r"))
    names = [*schema.names, *([CORRUPT] if keep_corrupt else [])]
    return parsed.select(*[F.col(f"r.`{n}`") for n in names])
