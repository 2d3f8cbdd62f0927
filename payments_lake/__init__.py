"""Spark jobs for wide payment ledgers: landing, silver, gold marts, profiles, validation."""

__version__ = "0.1.0"
