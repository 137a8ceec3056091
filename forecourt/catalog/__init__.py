"""Registered queries over the benchmark tables, each with its reference SQL."""
