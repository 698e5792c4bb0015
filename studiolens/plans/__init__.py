"""Loads, reports and the catalog of registered queries."""
