"""Batch pipelines composed of the operators."""
