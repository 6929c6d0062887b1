"""Tick analytics on Spark: ingest, curate, watch and report on price ticks."""
