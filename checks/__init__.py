"""Checked queries: each operator on fixture data, and its SQL oracle."""
