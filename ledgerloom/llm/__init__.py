"""Operators for preparing training text: filtering, deduplication, extraction, privacy, mixing and formatting."""
