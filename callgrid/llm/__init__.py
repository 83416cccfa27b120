"""Operators for preparing training data: ten methods over documents, vectors and pages."""
