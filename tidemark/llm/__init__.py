"""Operators for training-data pipelines. ``registry`` lists their queries."""
