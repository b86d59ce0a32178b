"""Partitioned topic logs on Spark: selection, start positions, progress, assignment."""
