"""Bindings of the operators to tables, and the query registry."""
