"""Tables of texts in, processed datasets and text exports out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from corpusloom.operators.splits import SPLITS


def dataset_name(base: str, version: str, vocab_size: int | None = None) -> str:
    """Name of a processed dataset: ``{base}-{vocab size}-{version}`` or ``{base}-{version}``."""
    parts = [base, version] if vocab_size is None else [base, str(vocab_size), version]
    return "-".join(parts)


def require_column(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to read texts from; there are {', '.join(df.columns)}")
    return df


def require_splits(df: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Fail unless every named split has rows; of a stored dataset, one row of each folder is read."""
    missing = [s for s in splits if df.where(F.col("split") == s).select("split").limit(1).count() == 0]
    if missing:
        raise ValueError(f"no rows in split {', '.join(missing)}")
    return df


def spread(df: DataFrame) -> DataFrame:
    """Give a small input, read as fewer parts than there are cores, to all cores.

    An input of any size is read as many parts and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_texts(
    spark: SparkSession, path: str, text_column: str = "text", schema: str | None = None
) -> DataFrame:
    """A Parquet table of texts; fails if the text column is missing."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return require_column(reader.parquet(path), text_column)


def read_json_lines(spark: SparkSession, path: str, schema: str, text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts from JSON lines, and the lines that do not fit: ``(rows, set_aside)``.

    ``rows`` has the columns of ``schema``, in which a field that a line lacks is null; ``set_aside`` has
    ``(file, line, raw)``, lines counted from 1, of lines that are no JSON object or hold a value of another type. Lines of white space
    alone are neither. Bytes that are no UTF-8 do not fit.
    """
    fields = T.StructType.fromDDL(schema)
    if _MISFIT in fields.names:
        raise ValueError(f"{_MISFIT!r} is no name for a field")
    marked = T.StructType([*fields, T.StructField(_MISFIT, T.StringType())])
    parsed = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MISFIT})
    lines = _lines(spark, path).where(~F.col("value").rlike(r"^\s*$")).withColumn("_row", parsed)
    # A value that is no object gives no field and, as an array of objects, no mark either.
    object_like = F.is_valid_utf8("value") & F.ltrim("value").startswith("{")
    fits = F.coalesce(object_like & F.col(f"_row.{_MISFIT}").isNull() & F.col("_row").isNotNull(), F.lit(False))
    rows = lines.where(fits).select(*[F.col("_row").getField(n).alias(n) for n in fields.names])
    return require_column(rows, text_column), _placed(spark, path, lines.where(~fits))


def read_text_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lines of text files as texts, ``(file, line, text)``, and those that are no UTF-8, ``(file, line, raw)``."""
    lines = _lines(spark, path)
    fits = F.is_valid_utf8("value")
    return _placed(spark, path, lines.where(fits)).withColumnRenamed("raw", "text"), _placed(spark, path, lines.where(~fits))


_MISFIT = "_does_not_fit"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of their part of a file: ``(file, block, at, value)``."""
    read = spark.read.text(path, lineSep="\n")
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _placed(spark: SparkSession, path: str, chosen: DataFrame) -> DataFrame:
    """``(file, line, raw)`` of some lines.

    Parts of a file are read side by side, so its lines are counted by part first; the window runs over parts, not lines.
    """
    parts = _lines(spark, path).groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    line = F.col("at") - F.col("first") + F.col("before") + 1
    return chosen.join(parts, ["file", "block"]).select("file", line.alias("line"), F.col("value").alias("raw"))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A processed dataset; a filter on ``split`` reads only that folder."""
    return require_splits(spark.read.parquet(path))


def write_dataset(df: DataFrame, path: str, mode: str = "error") -> None:
    """One folder for each split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def write_text(df: DataFrame, path: str, text_column: str = "text", mode: str = "error") -> None:
    """The texts, each followed by a line end, as a directory of text files."""
    df.select(text_column).where(F.col(text_column).isNotNull()).write.mode(mode).text(path)
