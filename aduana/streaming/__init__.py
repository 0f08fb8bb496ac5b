"""One-shot file streams."""
