"""Layered shop warehouse and its analytics, written as Spark DataFrame jobs."""
