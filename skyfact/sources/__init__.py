"""Readers: observation files, stored tables, weather, country outlines, mart files."""
