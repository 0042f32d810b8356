"""Logical plans: driver tables as the star schema, join helpers and jobs."""
