"""DataFrame operators: each is ``f(df, ..., params) -> DataFrame`` and lazy
unless its docstring says it runs a (small) job."""
