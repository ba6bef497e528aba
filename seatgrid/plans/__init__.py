"""Whole jobs, and the catalog of checked queries over the order tables."""
