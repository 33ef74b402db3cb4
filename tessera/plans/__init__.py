"""Contracts, merge rules, component plans, configuration and storage."""
