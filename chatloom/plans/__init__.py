"""Whole preparation runs composed from the operators."""
