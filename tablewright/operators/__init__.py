"""Operators: cleaning, statistics, joins, order statistics, sampling,
models and metrics. Each is a function from DataFrame to DataFrame."""
