"""Registered queries over the given tables, each with an SQL check where SQL can say it."""
