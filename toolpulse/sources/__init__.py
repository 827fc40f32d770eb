"""Readers, writers and durable tables."""
