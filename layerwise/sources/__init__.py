"""Scans and sinks of the layers."""
