"""Relational steps of the feed audit, one module per subject."""
