"""Readers and explicit schemas."""
