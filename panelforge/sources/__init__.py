"""Readers, writers and reports."""
