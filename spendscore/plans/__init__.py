"""Whole jobs: the layered pipeline and the registered queries."""
