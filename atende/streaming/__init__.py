"""Incremental reads: watermarks and file streams."""
