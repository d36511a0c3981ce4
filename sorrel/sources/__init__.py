"""Readers for files, catalogue tables and streams."""
