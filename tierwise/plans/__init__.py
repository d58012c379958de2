"""Registered queries (with their oracle SQL) and the layered batch run."""
