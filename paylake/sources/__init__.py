from paylake.sources.raw import raw_from_frame, read_raw_csv, read_raw_parquet
from paylake.sources.testdata import raw_transactions

__all__ = ["read_raw_csv", "read_raw_parquet", "raw_from_frame", "raw_transactions"]
