"""Spark table operators and incremental jobs for vehicle-listing lakes."""
