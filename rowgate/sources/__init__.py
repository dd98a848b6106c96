"""Reading tables and requests, writing accepted rows and new table versions."""

from rowgate.sources.requests import decode_bodies
from rowgate.sources.tables import (
    append_accepted,
    project_response,
    publish_version,
    read_version,
    scan_typed,
)

__all__ = [
    "append_accepted",
    "decode_bodies",
    "project_response",
    "publish_version",
    "read_version",
    "scan_typed",
]
