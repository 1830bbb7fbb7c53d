"""Snapshot-archive warehouse loading and operations reporting on Spark DataFrames."""
