"""Queries registered for checking, their inputs, and the SQL they must equal."""
