"""Spatial-scene curation analytics on Spark."""
