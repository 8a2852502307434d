"""Retail sales analytics on Spark."""
