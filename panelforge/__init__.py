"""panelforge: Spark-native operators for cleaning, reshaping and analysing
panel data (entity x time) at scale.

Every operator is a function ``f(df, ..., params) -> DataFrame`` that only
composes DataFrame / SQL expressions, so Catalyst sees the whole plan.  The only
values that reach the driver are small sufficient statistics (k x k Gram
matrices, per-spec counts) in :mod:`panelforge.plans.regression`.
"""

__version__ = "0.1.0"
