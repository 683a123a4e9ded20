"""Chains of operators: the history tables, the queries on them, their upkeep."""
