"""Reusable operators: DataFrame in, DataFrame out, lazy, built-in functions only."""
