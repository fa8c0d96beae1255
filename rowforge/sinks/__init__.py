"""Writers: files and catalog tables."""

from rowforge.sinks.files import write_csv, write_json, write_parquet
from rowforge.sinks.landing import land_table, resume_landing
from rowforge.sinks.tables import insert_table

__all__ = ["insert_table", "land_table", "resume_landing", "write_csv", "write_json", "write_parquet"]
