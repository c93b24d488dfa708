"""ledgerlens: sales and text analytics as plain Spark DataFrame functions.

Every public operator takes DataFrames (and plain parameters) and returns a
DataFrame.  The analytics operators never collect to the driver and use no Python
UDFs: their work is expressed with built-in ``pyspark.sql.functions`` so that it
stays inside whole-stage codegen and is planned by Catalyst + AQE.  Jobs run while a
query is built only in the sinks (``ledgerlens.sources.sinks``), for CSV schema
inference, and where ``session.materialize`` stores an intermediate table
(``country_summary*``, ``category_revenue`` and the CSV round trips).
"""

from ledgerlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
