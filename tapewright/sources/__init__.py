"""Readers: message log, recorded feed, archive."""
