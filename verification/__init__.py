"""Queries of the engine over the given tables, each beside an independent SQL statement."""
