"""Readers and writers for flow files."""
