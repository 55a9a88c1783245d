"""Parquet feature tables, external table registration and run records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronofeat.contracts import Contract, check_contract


def read_feature_table(
    spark: SparkSession, contract: Contract, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Scan under the declared schema: no footer is read to infer one."""
    df = spark.read.schema(contract.schema).parquet(path)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame, path: str, contract: Contract | None = None, partition_by: tuple[str, ...] = ()
) -> int:
    """Overwrite `path` and return the number of rows written, counted during the write.

    With `partition_by` only the partitions present in `df` are replaced.
    """
    if contract is not None:
        extra = [c for c in partition_by if c not in contract.columns]
        checked = check_contract(df.drop(*extra), contract)
        df = df.select(*checked.columns, *extra)
    written = Observation()
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return written.get["rows"]


def register_table(
    spark: SparkSession,
    contract: Contract,
    path: str,
    name: str | None = None,
    partition_by: dict[str, str] | None = None,
) -> str:
    """An external table with the contract's columns over the Parquet files at `path`.

    `partition_by` names partition columns and their types; folders that were added since the last
    call become partitions. A name that stands for another place is given to this one: the files of
    an external table are not touched. Registering again after a load is how readers by name see it.
    """
    name = name or contract.name
    parts = partition_by or {}
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    if spark.catalog.tableExists(name):
        held = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        if held is None or _place(spark, held["data_type"]) != _place(spark, path):
            spark.sql(f"DROP TABLE {name}")
    fields = [(f.name, f.dataType.simpleString()) for f in contract.schema if f.name not in parts]
    columns = ", ".join(f"`{c}` {kind}" for c, kind in [*fields, *parts.items()])
    split = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET{split} LOCATION '{path}'"
    )
    if parts:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")
    return name


def _place(spark: SparkSession, path: str) -> str:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(target).toString()


def write_run_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON document describing a run."""
    spark.createDataFrame([(json.dumps(record, default=str),)], "value string").coalesce(
        1
    ).write.mode("overwrite").text(path)


def read_run_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
