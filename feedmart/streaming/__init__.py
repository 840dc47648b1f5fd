"""Streams of files."""
