"""gridline.streaming."""
