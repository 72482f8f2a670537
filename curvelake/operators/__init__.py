"""Joins, aggregations, quantiles, ranking, sampling, smoothing and heat cells on tables."""
