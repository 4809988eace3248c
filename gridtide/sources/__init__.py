"""Readers of landed documents and text, inline tables, watermarks and table writers."""
