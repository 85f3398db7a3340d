"""Retail sales analytics as Spark DataFrame operators."""
