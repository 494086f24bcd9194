"""Queries bound to the driver tables, each beside its SQL statement."""
