"""Readers, writers and the binding to the shared test tables."""
