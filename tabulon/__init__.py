"""tabulon: labelled-table studies expressed as Spark DataFrame plans.

Every public operator is a plain function from DataFrames to a DataFrame.
Nothing collects unless its docstring says so, and what it collects is a
table whose size is bounded by the number of classes, features or folds.
"""

__all__ = ["session"]
