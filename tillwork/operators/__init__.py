"""Relational, merge, quality, experiment and Bayesian operators."""
