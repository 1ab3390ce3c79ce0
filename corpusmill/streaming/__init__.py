"""Structured Streaming forms of the monitor and the resumable append; an extension of the inventory."""
