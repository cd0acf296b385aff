"""gridline.sinks."""
