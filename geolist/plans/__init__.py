"""Flows over several operators and the registered queries."""
