"""Readers, writers and settings."""
