"""Sinks: result tables written through the DataFrame writer."""
