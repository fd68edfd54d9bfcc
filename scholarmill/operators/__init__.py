"""Relational jobs over papers, citations and scores."""
