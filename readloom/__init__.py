"""Spark jobs for short-read sequencing tables."""
