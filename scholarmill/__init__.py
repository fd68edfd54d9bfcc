"""Scholarly paper and citation-count analytics as Spark jobs."""
