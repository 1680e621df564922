"""Readers, writers, schemas and staging."""
