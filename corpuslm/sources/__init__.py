"""Readers, sinks and source selection for post tables."""
