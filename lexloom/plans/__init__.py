"""Whole flows, from tables to tables, out of the operators."""
