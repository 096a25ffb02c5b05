"""Readers, writers, and extraction from landed pages."""
