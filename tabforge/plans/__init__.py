"""Model selection, ensembles and comparison, put together from the operators and estimators."""
