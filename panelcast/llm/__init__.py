"""Operators for large training-data pipelines: formatting, archives, token files,
tokenising, filtering and de-duplication. Nothing outside this folder imports it."""
