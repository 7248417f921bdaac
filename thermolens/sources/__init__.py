"""Readers, writers, input guards and test-data generators."""
