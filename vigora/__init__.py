"""Vigora: what was in force, when, and why - a PySpark analytics engine for versioned data."""
