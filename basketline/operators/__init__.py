"""Reusable operators over any DataFrame; they take column names."""
