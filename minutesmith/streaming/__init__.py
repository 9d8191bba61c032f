"""Incremental import and event-time aggregates."""
