"""Relational operators of the reconciliation, one function per model/check."""
