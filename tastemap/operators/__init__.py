"""Operators of the recommender workflow, each a DataFrame → DataFrame plan."""
