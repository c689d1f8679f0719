"""Column-name normalisation (snake case, unique names)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_CAMEL_LOWER = re.compile(r"([a-z])([A-Z])")
_CAMEL_ACRONYM = re.compile(r"([A-Z]+)([A-Z][a-z])")
_NON_WORD = re.compile(r"[^0-9a-zA-Z]+")


def snake(name: str) -> str:
    """``AssessmentID`` -> ``assessment_id``, ``MSSubClass`` -> ``ms_sub_class``, ``Sale Price`` -> ``sale_price``.

    Case boundaries split words, digits stay attached to the word before them, any
    run of other characters becomes one ``_``; a leading digit gets an ``x`` prefix.
    """
    s = name.replace("%", "_percent_").replace("#", "_number_")
    s = _CAMEL_ACRONYM.sub(r"\1_\2", s)
    s = _CAMEL_LOWER.sub(r"\1_\2", s)
    s = _NON_WORD.sub("_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_name_list(names: list[str]) -> list[str]:
    """Snake-case every name and make the result unique with ``_2``, ``_3``... suffixes."""
    out: list[str] = []
    seen: dict[str, int] = {}
    taken = set()
    for n in names:
        base = snake(n)
        cand = base
        k = seen.get(base, 1)
        while cand in taken:
            k += 1
            cand = f"{base}_{k}"
        seen[base] = k
        taken.add(cand)
        out.append(cand)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to unique snake case (idempotent); a pure projection."""
    new = clean_name_list(df.columns)
    if new == df.columns:
        return df
    return df.toDF(*new)
