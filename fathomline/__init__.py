"""Fathomline: document analytics and hybrid retrieval on Spark."""
