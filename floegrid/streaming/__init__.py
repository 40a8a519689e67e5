"""Structured Streaming jobs over catalogue pages, slices, points and items."""
