"""Partition profiles and work plans."""
