"""Distributed operators: chunked ordered windows, exact quantiles, dense groupings, metrics."""
