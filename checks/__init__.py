"""Queries over the driver tables, one or more per operator, with their SQL."""
