"""Scoring on streams."""
