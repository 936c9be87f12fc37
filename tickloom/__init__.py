"""Tick features, labels, models, evaluation and drift as Spark jobs."""
