"""Element versions as streams."""
