"""Input tables derived from the driver's parquet tables.

The analysed inputs are two CSV files that are not shipped with the original
analysis: a risk-assessment table (one row per assessment and scale) and a house
sale table.  Both are rebuilt here from the TPC-H style tables so that their size
grows with the scale factor.  Column names are kept in their raw CSV style
(``AssessmentID``, ``SalePrice``...) so that :func:`tabmill.functions.names.clean_names`
has real work to do, exactly as in the original loaders.

The Spark builders use the DataFrame API; ``*_RAW_SQL`` are the same tables in
DuckDB SQL, used only by the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The three prediction tasks (display text) and their scale-set number.
SCALES = [
    (1, "Risk of Violence"),
    (2, "Risk of Recidivism"),
    (3, "Risk of Failure to Appear"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, scale): the risk-score table with raw CSV column names."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    scale = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("t")) for k, t in SCALES]))
    base = o.join(c, o.o_custkey == c.c_custkey).select("*", scale.alias("sc"))
    cust, order, k = F.col("o_custkey"), F.col("o_orderkey"), F.col("sc.k")
    mix = (cust * 7 + order * 3 + k) % 10
    dob = F.concat(
        (1 + cust % 12).cast("string"), F.lit("/"),
        (1 + cust % 28).cast("string"), F.lit("/"),
        F.substring((1940 + cust % 66).cast("string"), 3, 2),
    )
    return base.select(
        cust.alias("Person_ID"),
        order.alias("AssessmentID"),
        k.cast("int").alias("ScaleSet"),
        F.when(cust % 5 == 0, "Female").otherwise("Male").alias("Sex_Code_Text"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "African-American")
        .when(F.col("c_mktsegment") == "FURNITURE", "Caucasian")
        .when(F.col("c_mktsegment") == "BUILDING", "Hispanic")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Other")
        .otherwise("Asian").alias("Ethnic_Code_Text"),
        F.when(cust % 97 == 0, F.lit(None).cast("string")).otherwise(dob).alias("DateOfBirth"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Jail Inmate")
        .when(F.col("o_orderpriority") == "2-HIGH", "Probation")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Pretrial Defendant")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Prison Inmate")
        .otherwise("Parole").alias("CustodyStatus"),
        F.col("sc.t").alias("DisplayText"),
        F.when(F.col("o_orderstatus") == "P", "Single")
        .when(F.col("o_orderstatus") == "O", "Married")
        .otherwise("Divorced").alias("MaritalStatus"),
        F.when(mix < 5, F.when(cust % 66 > 40, "High").otherwise("Low"))
        .when(mix < 8, "Medium")
        .otherwise("High").alias("ScoreText"),
    )


def raw_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the house-sale table with raw CSV column names."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # partial (map-side) aggregation before the shuffle on l_orderkey
    q = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(q, o.o_orderkey == q.l_orderkey, "left")
    key = F.col("o_orderkey")
    return j.select(
        key.alias("Id"),
        (50000 + 900 * F.coalesce(F.col("q"), F.lit(0.0)) + F.col("o_totalprice") / 20).alias("SalePrice"),
        F.col("q").alias("GrLivArea"),
        F.when(key % 13 == 0, F.lit(None).cast("double")).otherwise((key % 97).cast("double")).alias("LotFrontage"),
        (F.col("c_nationkey") % 10).cast("int").alias("OverallQual"),
        F.month("o_orderdate").cast("int").alias("MoSold"),
        F.year("o_orderdate").cast("int").alias("YrSold"),
        F.concat(F.lit("C"), F.col("o_orderstatus")).alias("MSSubClass"),
        F.col("c_mktsegment").alias("Neighborhood"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 100 < 3, "CarPort")
        .when(key % 100 < 6, "Basment")
        .when(key % 100 < 50, "Detchd")
        .otherwise("Attchd").alias("GarageType"),
        F.when(key % 20 == 0, "Grvl").otherwise("Pave").alias("Street"),
        F.when(key % 4 == 0, "Gd").otherwise(F.lit(None).cast("string")).alias("PoolQC"),
        F.lit("AllPub").alias("Utilities"),
    )


# ---------------------------------------------------------------------------
# DuckDB text of the same two tables (oracle only).

ASSESSMENTS_RAW_SQL = """
select o.o_custkey as "Person_ID", o.o_orderkey as "AssessmentID", cast(sc.k as int) as "ScaleSet",
  case when o.o_custkey % 5 = 0 then 'Female' else 'Male' end as "Sex_Code_Text",
  case c.c_mktsegment when 'MACHINERY' then 'African-American' when 'FURNITURE' then 'Caucasian'
    when 'BUILDING' then 'Hispanic' when 'AUTOMOBILE' then 'Other' else 'Asian' end as "Ethnic_Code_Text",
  case when o.o_custkey % 97 = 0 then null else
    concat(cast(1 + o.o_custkey % 12 as varchar), '/', cast(1 + o.o_custkey % 28 as varchar), '/',
           substr(cast(1940 + o.o_custkey % 66 as varchar), 3, 2)) end as "DateOfBirth",
  case o.o_orderpriority when '1-URGENT' then 'Jail Inmate' when '2-HIGH' then 'Probation'
    when '3-MEDIUM' then 'Pretrial Defendant' when '4-NOT SPECIFIED' then 'Prison Inmate' else 'Parole' end as "CustodyStatus",
  sc.t as "DisplayText",
  case o.o_orderstatus when 'P' then 'Single' when 'O' then 'Married' else 'Divorced' end as "MaritalStatus",
  case when (o.o_custkey * 7 + o.o_orderkey * 3 + sc.k) % 10 < 5 then case when o.o_custkey % 66 > 40 then 'High' else 'Low' end
       when (o.o_custkey * 7 + o.o_orderkey * 3 + sc.k) % 10 < 8 then 'Medium' else 'High' end as "ScoreText"
from orders o join customer c on o.o_custkey = c.c_custkey
cross join (select 1 as k, 'Risk of Violence' as t union all select 2, 'Risk of Recidivism'
            union all select 3, 'Risk of Failure to Appear') sc
"""

HOUSES_RAW_SQL = """
select o.o_orderkey as "Id", 50000 + 900 * coalesce(g.q, 0) + o.o_totalprice / 20 as "SalePrice",
  g.q as "GrLivArea",
  case when o.o_orderkey % 13 = 0 then null else cast(o.o_orderkey % 97 as double) end as "LotFrontage",
  cast(c.c_nationkey % 10 as int) as "OverallQual", cast(extract(month from o.o_orderdate) as int) as "MoSold",
  cast(extract(year from o.o_orderdate) as int) as "YrSold",
  concat('C', o.o_orderstatus) as "MSSubClass", c.c_mktsegment as "Neighborhood",
  case when o.o_orderkey % 11 = 0 then null when o.o_orderkey % 100 < 3 then 'CarPort'
    when o.o_orderkey % 100 < 6 then 'Basment' when o.o_orderkey % 100 < 50 then 'Detchd' else 'Attchd' end as "GarageType",
  case when o.o_orderkey % 20 = 0 then 'Grvl' else 'Pave' end as "Street",
  case when o.o_orderkey % 4 = 0 then 'Gd' else null end as "PoolQC", 'AllPub' as "Utilities"
from orders o join customer c on o.o_custkey = c.c_custkey
left join (select l_orderkey, sum(l_quantity) as q from lineitem group by l_orderkey) g on o.o_orderkey = g.l_orderkey
"""
