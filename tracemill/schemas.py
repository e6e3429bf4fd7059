"""Row shapes shared by all stages."""

FILES = (
    "path STRING, name STRING, parent STRING, entry_type STRING, length BIGINT, "
    "mtime TIMESTAMP_NTZ, content BINARY"
)

TIMES = "ARRAY<STRUCT<timestamp_desc: STRING, timestamp: TIMESTAMP_NTZ>>"
ATTRIBUTES = "MAP<STRING, STRING>"

RESULTS = (
    "container STRING, path STRING, parser STRING, seq BIGINT, message STRING, "
    f"attributes {ATTRIBUTES}, times {TIMES}"
)

UNPACKED = (
    "path STRING, name STRING, source_path STRING, depth INT, mtime TIMESTAMP_NTZ, "
    "content BINARY, length BIGINT, kept BOOLEAN, warning STRING, ancestors ARRAY<BINARY>"
)

EVENT_DATA = "event_data"
EXTRACTION_WARNING = "extraction_warning"
RECOVERY_WARNING = "recovery_warning"
EXTRACTION_ERROR = "extraction_error"

FILE = "file"
DIRECTORY = "directory"
NOT_A_TIME = "Not a time"
