"""Estimators and models. Spark makes the pass over the data; fitted state is small."""
