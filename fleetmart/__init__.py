"""Ride-hailing warehouse jobs on Spark: ingest, clean, load, marts, export."""
