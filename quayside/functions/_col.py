"""Small helper: accept a column name or a Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
