"""Scans and streams."""
