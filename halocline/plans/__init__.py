"""Whole jobs built from the operators: from stored fields to stored results."""
