"""gridline.plans."""
