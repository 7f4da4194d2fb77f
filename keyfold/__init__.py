"""keyfold: keyed, running and windowed analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; nothing is collected to
the driver.  Batch operators and their streaming forms share the same column
contracts, so a query can be checked on a table and replayed on a stream.
"""

from keyfold.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
