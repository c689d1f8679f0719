"""Birth-date parsing and age buckets, all as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference year for ages, bucket bounds (inclusive) and bucket labels.
REFERENCE_YEAR = 2014
YOUNG_LIMIT = 25
OLD_LIMIT = 45
LABEL_MIDDLE = "25 to 45"
LABEL_YOUNG = "Younger than 25"
LABEL_OLD = "Older than 45"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mdy(c) -> Column:
    """Month/day/year text to a date; NULL when it does not parse (never raises under ANSI).

    Two-digit years are tried first: each pattern rejects the other's width, so the
    order does not change results, but a failed parse is costly and the raw files
    carry two-digit years.
    """
    x = _col(c)
    return F.coalesce(F.try_to_date(x, "M/d/yy"), F.try_to_date(x, "M/d/yyyy"))


def birth_year(c, repair_century: bool = True) -> Column:
    """Year of birth as a double.  With ``repair_century`` a leading ``20`` becomes ``19``
    (two-digit years are read as 20yy by Spark, so every year ends up 19yy)."""
    y = F.year(parse_mdy(c)).cast("string")
    if repair_century:
        y = F.regexp_replace(y, "^20", "19")
    return y.try_cast("double")


def age_years(c, repair_century: bool = True) -> Column:
    return F.lit(float(REFERENCE_YEAR)) - birth_year(c, repair_century)


def bucket_age(age: Column) -> Column:
    """Three buckets, bounds inclusive in the middle one, no ELSE branch (NULL stays NULL)."""
    return (
        F.when((age >= YOUNG_LIMIT) & (age <= OLD_LIMIT), LABEL_MIDDLE)
        .when(age < YOUNG_LIMIT, LABEL_YOUNG)
        .when(age > OLD_LIMIT, LABEL_OLD)
    )


def age_bucket(c, repair_century: bool = True) -> Column:
    """Raw ``M/d/yy`` birth date -> age bucket text."""
    return bucket_age(age_years(c, repair_century))
