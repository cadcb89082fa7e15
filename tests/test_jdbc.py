"""JDBC sink configuration (no live database is available here)."""

from paylake.sources.jdbc import column_types, jdbc_options


def test_column_types_follow_schemas():
    assert column_types("dim_merchants") == (
        "merchant_id VARCHAR(255), merchant_name VARCHAR(255), merchant_category VARCHAR(255)")
    fact = column_types("fact_transactions")
    assert "amount DOUBLE" in fact and "transaction_date DATE" in fact
    assert "total_transactions BIGINT" in column_types("daily_merchant_summary")


def test_options():
    opts = jdbc_options("jdbc:postgresql://h/db", user="u", password="p",
                        driver="org.postgresql.Driver", batch_size=500)
    assert opts == {"batchsize": "500", "user": "u", "password": "p",
                    "driver": "org.postgresql.Driver"}


def test_column_types_parse(spark):
    from paylake.schemas import TABLES
    from pyspark.sql import types as T
    for name, (schema, _k, _p) in TABLES.items():
        assert T.StructType.fromDDL(column_types(name)).names == schema.names


def test_writer_caps_connections(spark, monkeypatch):
    """The cap is the writer's option; the frame itself is not coalesced."""
    from paylake.schemas import DIM_MERCHANTS
    from paylake.sources import jdbc
    seen = {}

    class Writer:
        def mode(self, m):
            seen["mode"] = m
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def jdbc(self, url, name, properties):
            seen.update(url=url, name=name, properties=properties)

    class Frame:
        write = Writer()

        def select(self, *cols):
            assert list(cols) == DIM_MERCHANTS.names
            return self

    jdbc.append_all({"dim_merchants": Frame()}, "jdbc:x", {"user": "u"}, num_partitions=3)
    assert seen["numPartitions"] == 3 and seen["mode"] == "append"
    assert seen["name"] == "dim_merchants" and seen["url"] == "jdbc:x"
