"""Structured Streaming sources and stateful operators over change feeds."""
