"""Read the five reconciliation tables from files or from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("insurance_firm", "insurance_firm_oa", "patient_insurance", "pms_claims", "payers_oa")


def load_tables(spark: SparkSession, path: str, tables=TABLES, fmt: str = "parquet",
                **options) -> dict[str, DataFrame]:
    """One DataFrame per table below ``path``; filters and columns are pushed into the scan."""
    return {t: spark.read.format(fmt).options(**options).load(f"{path}/{t}") for t in tables}


def load_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 64,
              **options) -> DataFrame:
    """Read a database table, in parallel ranges of a numeric key if one is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its key")
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1],
                                numPartitions=partitions)
    return reader.load()
