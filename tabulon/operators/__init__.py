"""Operators: audit, sampling, features, neighbours, trees, rules, metrics,
statistics, bounds and checks. Each is a function of DataFrames."""
