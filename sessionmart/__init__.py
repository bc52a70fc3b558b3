"""sessionmart -- a PySpark pipeline for sparse intraday bar data.

Raw one-minute OHLCV bars plus two small reference tables are conformed,
converted to New York session time, and built into layered DataFrames
(staging -> intermediate -> marts), with reports and a data-quality suite whose
checks are themselves Spark queries. Built-in expressions only, no Python UDFs.
"""

__version__ = "0.1.0"
