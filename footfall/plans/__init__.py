"""Whole jobs put together from the feature families."""
