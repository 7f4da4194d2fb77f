"""Column-level helpers: line parsing and result formatting."""
