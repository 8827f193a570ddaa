"""Operators: plain ``DataFrame(s) -> DataFrame`` functions."""
