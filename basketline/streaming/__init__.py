"""Loads that carry state from one run to the next."""
