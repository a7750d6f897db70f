"""Spoken-dialogue data preparation as Spark DataFrame plans."""

from duologue.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]
