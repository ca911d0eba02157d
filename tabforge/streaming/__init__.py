"""Stateless operators and fitted models on file streams."""
