"""Readers: files, text lines, catalog tables."""

from rowforge.sources.files import read_csv, read_json, read_lines
from rowforge.sources.lines import TextField, parse_delimited, parse_json_lines, split_corrupt
from rowforge.sources.tables import extract_table

__all__ = [
    "TextField",
    "extract_table",
    "parse_delimited",
    "parse_json_lines",
    "read_csv",
    "read_json",
    "read_lines",
    "split_corrupt",
]
