"""Operators for preparing text as training data; nothing outside this subpackage depends on it."""
