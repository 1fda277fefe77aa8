"""Operators the built-in DataFrame API does not provide as one call."""
