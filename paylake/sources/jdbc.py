"""Append the four tables to a JDBC warehouse.

The reference appends to PostgreSQL when a host is configured and swallows
errors; here the append is a plain ``DataFrameWriter.jdbc`` call and a failed
write raises.  Column types for tables the writer creates come from the
schemas (``createTableColumnTypes``, which takes Spark SQL type names).  Writes
run one connection per task; ``num_partitions`` is the writer's own cap on
concurrent connections, so give it frames that are staged: the cap applies to
the stage that feeds the writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paylake.schemas import TABLES

_JDBC_TYPES = {
    T.StringType: "VARCHAR(255)", T.DoubleType: "DOUBLE", T.LongType: "BIGINT",
    T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
}


def column_types(name: str) -> str:
    schema = TABLES[name][0]
    return ", ".join(f"{f.name} {_JDBC_TYPES[type(f.dataType)]}" for f in schema.fields)


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 10_000) -> dict[str, str]:
    props = {"batchsize": str(batch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    return props


def append_table(df: DataFrame, name: str, url: str, props: dict[str, str],
                 num_partitions: int | None = None) -> None:
    out = df.select(*[f.name for f in TABLES[name][0].fields])
    writer = out.write.mode("append").option("createTableColumnTypes", column_types(name))
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.jdbc(url, name, properties=props)


def append_all(tables: dict[str, DataFrame], url: str, props: dict[str, str],
               num_partitions: int | None = None) -> None:
    for name in ("dim_users", "dim_merchants", "fact_transactions", "daily_merchant_summary"):
        if name in tables:
            append_table(tables[name], name, url, props, num_partitions)
