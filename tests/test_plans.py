"""Plan-shape claims made in the README, checked on the physical plan."""

import contextlib
import io

from pyspark.sql import functions as F

from tabmill.operators.clean import nth_row_per_group


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_nth_row_limits_each_group_before_the_shuffle(spark):
    # one hot group holding most rows: each map task must forward at most n rows of it
    df = spark.range(10_000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("o"))
    plan = _plan(nth_row_per_group(df, ["g"], ["o"], 2))
    lines = [ln.strip() for ln in plan.splitlines()]
    limit_below_exchange = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln]
    exchange = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert exchange and limit_below_exchange
    # the physical plan prints top-down: a partial limit appears after (below) the exchange
    assert max(limit_below_exchange) > min(exchange)
    got = {r["g"]: r["o"] for r in nth_row_per_group(df, ["g"], ["o"], 2).collect()}
    assert got == {0: 2, 1: 3}
