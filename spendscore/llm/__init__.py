"""Operators for large training-data tables, and the pipeline built from them."""
