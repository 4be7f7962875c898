"""Readers with header contracts, and extraction from pages and text rows."""
