"""Scalar column functions."""
from . import parse, text, vector  # noqa: F401
