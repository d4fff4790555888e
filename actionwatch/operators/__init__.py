"""Operators: DataFrame in, DataFrame out. Dates that stand for "today" are always arguments."""
