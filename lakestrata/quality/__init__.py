"""Declarative data-quality suites."""
