"""Relational operators: sessions, metrics, registry and monitor queries."""
