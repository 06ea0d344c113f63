from refinery.sources.raw_json import (
    discover_schema,
    parse_lines,
    parse_records,
    read_lines,
    read_raw,
    read_records,
    shape_raw,
)
from refinery.sources.tables import read_bronze, read_gold, read_if_exists, read_silver

__all__ = [
    "discover_schema",
    "parse_lines",
    "parse_records",
    "read_lines",
    "read_bronze",
    "read_gold",
    "read_if_exists",
    "read_raw",
    "read_records",
    "read_silver",
    "shape_raw",
]
