"""Layered analytics pipelines from pure DataFrame operators."""
