"""Readers and writers of request logs and report tables."""
