"""Readers, writers and the account panel."""
