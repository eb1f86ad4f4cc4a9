"""Scans, sinks, sync-state tables and payload decoding."""
