from keyfold.sources.tables import load, TABLES
from keyfold.sources.text import read_lines, line_stream, with_line_numbers

__all__ = ["load", "TABLES", "read_lines", "line_stream", "with_line_numbers"]
