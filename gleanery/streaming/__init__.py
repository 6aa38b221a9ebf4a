"""Continuous consolidation of landed pages."""
