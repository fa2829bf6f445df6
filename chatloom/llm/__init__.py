"""Operators for preparing large text corpora; see README.md in this folder."""
