"""Readers: every scan declares its schema."""
