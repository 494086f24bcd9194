"""Reusable plan shapes: segmented windows, exact quantiles, merges, graph walks, check suites."""
