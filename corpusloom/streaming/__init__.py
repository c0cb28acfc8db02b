"""The preparation of texts that keep arriving."""
