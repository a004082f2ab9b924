"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space [\x20\x09-\x0D]; every other character belongs to a word.
BLANKS = "\t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(text: Column) -> Column:
    """Text with each white-space character turned into a space, outer spaces removed (null: '')."""
    return F.trim(F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS)))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text in order (null or blank: empty array)."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " +"))


def n_words(text: Column) -> Column:
    t = trimmed(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, " +"))).cast("long")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id's decimal text modulo ``m`` (null id: 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m)), F.lit(0))
