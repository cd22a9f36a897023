"""Sources and sinks: delimited files, line files, stored tables, reports."""

from ..session import load_table  # noqa: F401
from .delimited import read_delimited, select_positions, write_delimited  # noqa: F401
from .lines import explode_lines, read_lines, write_lines  # noqa: F401
from .reports import describe_schema, preview, rename_columns, split_counts  # noqa: F401
