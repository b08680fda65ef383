"""Datasets, SQL over datasets, transforms, and the registered queries, composed from the operators."""
