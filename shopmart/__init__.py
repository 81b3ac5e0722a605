"""Medallion analytics for an e-commerce marketplace on PySpark."""
