"""Compositions: the warehouse build and the reports on it."""
