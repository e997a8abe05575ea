"""What the corpus operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.operators.tables import written as durable

__all__ = ["ASCII_UPPER", "LOWER", "ascii_lower", "durable", "fold", "only", "table", "texts"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: For bytes.translate: lower-cases A-Z and nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator needs, so that others cannot clash with those it adds."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
