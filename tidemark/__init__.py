"""tidemark: keep an analytic warehouse fresh, clean and trustworthy, on PySpark.

Everything here is a plain function from DataFrames (or Columns) to DataFrames
(or Columns).  Plans stay lazy; the few functions that run a job say so.
"""

__version__ = "0.1.0"
