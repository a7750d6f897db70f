"""Queries over the check tables, each with its SQL counterpart."""
