"""Whole stages built from the operators: joined table, features, training, analysis."""
