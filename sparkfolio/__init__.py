"""sparkfolio: time-series analytics for price bars on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame (lazily); actions
happen only in the composite jobs of :mod:`sparkfolio.plans` and in sinks.

Layout
------
``sources``    readers, writers, landing-zone operators
``functions``  column-level helpers (null-on-failure casts, rounding)
``operators``  quality, SCD2, as-of join, indicators, features, backtest,
               metrics, model, scoring, long-series (chunked) windows
``plans``      fixtures over the driver tables and the registered queries
"""

__version__ = "0.1.0"
