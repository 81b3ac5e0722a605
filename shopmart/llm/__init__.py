"""Operators for training-data pipelines on tables of documents."""
