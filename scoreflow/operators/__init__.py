"""Operators: features, validation, splits, metrics, learners, ensembles."""
