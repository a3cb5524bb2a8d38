"""Whole plans: adapters from the given tables, pipelines and the registered queries."""
