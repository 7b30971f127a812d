"""Operators of a training-data pipeline (see the README's section on them)."""
