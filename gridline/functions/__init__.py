from .columns import batch_id, blank_to_null, default_to, full_name, short_name, shorten, title_case, weighted_score, zero_pad

__all__ = ["batch_id", "blank_to_null", "default_to", "full_name", "short_name", "shorten", "title_case",
           "weighted_score", "zero_pad"]
