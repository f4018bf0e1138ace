"""Readers and writers; the only modules that touch storage."""
