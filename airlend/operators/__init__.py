"""The analyses, one module per subject."""
