"""Readers for the base tables."""
