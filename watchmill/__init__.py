"""Threat analytics over access logs, connection logs and user profiles, as Spark jobs."""
