"""Ids of any type as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number(df: DataFrame, id_col: str) -> Column:
    """The id as a 64-bit number: whole numbers as they are, others by a digest, null as null.

    Two ids of one digest are told apart only by what else keys a row; operators add the text's digest.
    """
    if isinstance(df.schema[id_col].dataType, T.IntegralType):
        return F.col(id_col).cast("long")
    return F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
