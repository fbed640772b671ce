"""Adapters from the driver's tables and the registry of runnable queries."""
