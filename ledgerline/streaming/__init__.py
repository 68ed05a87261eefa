"""Incremental folder intake with Structured Streaming."""
