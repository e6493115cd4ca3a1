"""Tidewake: marine telemetry archive and analytics on Spark DataFrames."""
