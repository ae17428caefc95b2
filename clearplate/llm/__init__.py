"""Operators of a training-data pipeline over documents and pages."""
