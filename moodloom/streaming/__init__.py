"""Scoring of newly arriving texts with a fitted model."""
