"""Composed jobs and the checked queries over the driver tables."""
