"""Inputs, their mapping onto logical tables, and the sinks."""
