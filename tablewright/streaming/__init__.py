"""Change logs, batch and streaming."""
