"""gridline.sources."""
