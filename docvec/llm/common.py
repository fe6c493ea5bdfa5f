"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.sources.storage import work_folder

# Fixed value: a word is a run of anything but space and the five ASCII breaks.
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared work folder and read back.

    Cuts lineage and survives lost executors: what is written is computed once.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """Tasks that keep the cluster busy."""
    return max(2 * spark.sparkContext.defaultParallelism, 2)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(pieces, lambda w: w != "")


def hash_unit(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of an MD5 digest.

    MD5 and not xxhash64, so that plain SQL engines give the same number.
    """
    text = F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))
