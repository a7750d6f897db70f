"""End-to-end plans built from sources, functions and operators."""
