"""Layered (raw -> clean -> ready) analytics tables as PySpark jobs."""
