"""Structured Streaming wiring. The only package that starts queries."""
