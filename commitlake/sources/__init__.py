"""Raw streams: envelope schema, scans, landing writers and fixture streams."""

from commitlake.sources.envelope import (  # noqa: F401
    land_envelope, parse_payload, raw_view, read_jsonl, read_raw, select_streams, write_jsonl,
)
from commitlake.sources.schemas import ENVELOPE, SDC_COLUMNS, STREAM_FIELDS  # noqa: F401
