"""Readers. Every reader takes its options from the caller; none holds
credentials or host names."""
