"""DataFrame-in, DataFrame-out operators, independent of any particular table."""
