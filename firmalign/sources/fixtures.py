"""Derive the five reconciliation tables from the benchmark's star-schema tables.

Each rule is a plain column expression over ``customer``, ``supplier``, ``orders`` or
``lineitem``, so every table grows with its input and its filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import vocabulary as v

# fixed values: feed transactions, and the run time stamped on derived results
TRANSACTIONS = ("837P Professional", "837I Institutional", "270 Eligibility")
RUN_TS = "2024-01-01 00:00:00"
# A customer whose number the divisor divides hands its rows to the one before, the first to the next.
_NEIGHBOUR = ("CAST(o_custkey + CASE WHEN o_custkey % {0} <> 0 THEN 0 WHEN o_custkey = 0 THEN 1 "
              "ELSE -1 END AS BIGINT)")


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}.parquet")


def insurance_firm(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS k", "c_name", "CAST(c_custkey % 10 AS INT) AS digit",
    ).selectExpr(
        "k AS firm_id",
        """CASE WHEN k % 50 = 12 THEN concat('FAC', k - 2)
                WHEN digit IN (0, 1, 2, 8) THEN concat('FAC', k)
                WHEN digit IN (3, 4) THEN concat('PRO', k)
                WHEN digit = 5 THEN concat('ELG', k)
                WHEN digit = 6 THEN concat('OLD', k)
                WHEN digit = 9 THEN concat('GARB', k) END AS payer_id""",
        """CASE WHEN k % 97 = 0 THEN NULL
                WHEN digit = 8 THEN concat(c_name, ' Inc')
                WHEN digit = 9 THEN concat('TEST ', k)
                WHEN k % 23 = 0 THEN concat(' ', c_name, '  x ')
                WHEN k % 2 = 0 THEN upper(c_name)
                ELSE c_name END AS name""",
        *[f"CAST(NULL AS STRING) AS {c}" for c in v.PAYLOAD_COLS])


def insurance_firm_with_sub_ids(spark: SparkSession, path: str) -> DataFrame:
    """Firms whose unmatched rows already store sub-payer ids of an earlier life."""
    return insurance_firm(spark, path).withColumns({
        "payer_id_fac": F.expr("IF(firm_id % 10 = 9, concat('FAC', firm_id - 1), NULL)"),
        "payer_id_pro": F.expr("IF(firm_id % 10 = 9, concat('PRO', firm_id - 2), NULL)")})


def insurance_firm_oa(spark: SparkSession, path: str, key_mode: str = "multi") -> DataFrame:
    """Master rows; customers whose number ends in 9 have none, which makes their firms garbage."""
    # Most customers give one master row, some a second one that fans their matches out.
    customer = _read(spark, path, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS k", "c_name").selectExpr("k", """
            inline(filter(array(
                struct(k AS firm_id, c_name AS name, k % 10 <> 9 AS kept),
                struct(2000000 + k AS firm_id, IF(k % 80 = 1, c_name, concat(c_name, ' DUP')) AS name,
                       k % 40 = 1 AS kept)), r -> r.kept))""").drop("kept")
    supplier = _read(spark, path, "supplier").selectExpr(
        "1000000 + CAST(s_suppkey AS BIGINT) AS k", "s_name").selectExpr(
        "k", "k AS firm_id", "s_name AS name")
    ids = [f"IF({gap} OR k % 50 = 6, NULL, concat('{prefix}', k)) AS {c}" for c, prefix, gap in (
        ("payer_id_fac", "FAC", "k % 7 = 3"), ("payer_id_pro", "PRO", "k % 11 = 5"),
        ("payer_id_elig", "ELG", "k % 13 = 4"))]
    flags = [f"IF(k % {i} = 0, 'Yes', 'No') AS {c}"
             for i, c in enumerate(v.FLAG_COLS + v.ENROLLMENT_COLS, 2)]
    payer = "coalesce(payer_id_fac, payer_id_pro, payer_id_elig)"
    payer = payer if key_mode == "single" else "CAST(NULL AS STRING)"
    return customer.unionByName(supplier).selectExpr("firm_id", "name", *ids, *flags).selectExpr(
        "firm_id", f"{payer} AS payer_id", "name", *v.PAYLOAD_COLS)


def patient_insurance(spark: SparkSession, path: str) -> DataFrame:
    # Every third firm has no patients: its orders point at a neighbour.
    order = F.col("o_orderkey").cast("bigint")
    cust = F.expr(_NEIGHBOUR.format(3))
    firm = (F.when(order % 203 == 0, F.lit(None)).when(order % 101 == 0, cust + 10000000)
            .otherwise(cust))
    return _read(spark, path, "orders").select(
        order.alias("patient_insurance_id"), firm.alias("insurance_firm_id"))


def pms_claims(spark: SparkSession, path: str) -> DataFrame:
    line = _read(spark, path, "lineitem").select("l_orderkey", "l_linenumber")
    # Every fourth firm has no claims, in the same way.
    order = _read(spark, path, "orders").selectExpr(
        "o_orderkey", _NEIGHBOUR.format(4) + " AS cust")
    key = F.col("l_orderkey").cast("bigint")
    firm = F.when(key % 211 == 0, F.lit(None)).otherwise(F.col("cust"))
    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        (key * 10 + F.col("l_linenumber")).alias("claim_id"), firm.alias("insurance_firm_id"))


def payers_oa(spark: SparkSession, path: str) -> DataFrame:
    """Three feed rows per payer; every ninth master row lacks one, for the cardinality check."""
    return (
        insurance_firm_oa(spark, path, "single").where("payer_id IS NOT NULL")
        .select("firm_id", "payer_id", "name",
                F.explode(F.array(*map(F.lit, TRANSACTIONS))).alias("transaction"))
        .where(~((F.col("firm_id") % 9 == 0) & F.col("transaction").contains("Eligibility")))
        .drop("firm_id")
    )
