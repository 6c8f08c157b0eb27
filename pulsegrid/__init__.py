"""Figures of sensor telemetry, in batch and as streams, on Spark DataFrames."""
