"""Derived input tables and the query registry."""
