"""Small string helpers as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def str_remove_first_digit(c) -> Column:
    """Remove the first digit only (Spark's ``regexp_replace`` alone would remove every match)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(x, r"^([^0-9]*)[0-9]", "$1")
