"""Readers for charger logs, message topics and the history table."""
