"""Reading and writing tables."""

from panelwright.sources.files import read_delimited, read_table, write_delimited, write_table
from panelwright.sources.layout import (
    labels,
    lay_out,
    read_labels,
    read_laid_out,
    with_labels,
    with_position,
    write_labels,
)
from panelwright.sources.sql import read_jdbc, run_sql

__all__ = [
    "labels",
    "lay_out",
    "read_delimited",
    "read_jdbc",
    "read_labels",
    "read_laid_out",
    "read_table",
    "run_sql",
    "with_labels",
    "with_position",
    "write_delimited",
    "write_labels",
    "write_table",
]
