"""Relational operators: pairing, sessions, tracking, topics, tables and quality checks."""
