"""Operators: pure DataFrame → DataFrame functions over logs, manifests, catalogs and edges."""
