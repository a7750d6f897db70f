"""Readers and adapters that bring outside data to the common schemas."""
