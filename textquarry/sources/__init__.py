"""Readers and writers; every scan takes an explicit schema or a self-describing format."""
