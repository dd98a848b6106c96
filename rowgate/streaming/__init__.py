"""Request streams."""

from rowgate.streaming.streams import InsertRules, apply_batch, drain, stream_apply, stream_compact, stream_fk_check

__all__ = ["InsertRules", "apply_batch", "drain", "stream_apply", "stream_compact", "stream_fk_check"]
