"""Readers and scans."""
