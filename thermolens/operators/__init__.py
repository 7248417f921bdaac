"""Relational and ML operators: ``f(df, ...) -> DataFrame``."""
