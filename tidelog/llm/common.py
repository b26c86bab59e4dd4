"""Shared pieces: words, safe column names, tables kept in the shared folder.

A *word* is a maximal run of bytes outside space and \\x09-\\x0D, everywhere in
this subpackage. ``bytes.split()`` and ``bytes.lower()`` cut and fold exactly
so (ASCII only), which the Python-side operators rely on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import stored  # noqa: F401 - used by the operators

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array (null: empty)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. Plain ASCII texts take
    the engine's fast ``lower``; the rest is translated letter by letter."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def two_hashes(value: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds: 128 bits, so that equal hashes
    mean equal strings at any realistic number of strings."""
    return [F.xxhash64(value), F.xxhash64(F.lit(0x7465787468), value)]


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
