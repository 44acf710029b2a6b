"""Operators: splits, checks, statistics, features, models, metrics, explanations."""
