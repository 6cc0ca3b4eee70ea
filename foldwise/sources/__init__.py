"""Readers, writers, the model store and the settling of intermediate tables."""
