"""These must equal the reference's behaviour for results to match.

They are stated once, here, and imported where used.
"""

# Fixed values (must equal the reference's behaviour):
# key wrapping a payload item or value that is not an object
VALUE_KEY = "value"
# record that replaces an object left with no keys after cleaning
PLACEHOLDER_KEY = "placeholder"
PLACEHOLDER_VALUE = "empty_record"
# names given to positional columns: column_0, column_1, ...
GENERIC_PREFIX = "column_"
# table scanned when a source names neither a table nor a query
DEFAULT_TABLE = "data"
# schedule shape: five space-separated fields of digits and * - , /
CRON_PATTERN = r"^[\d\*\-,/]+ [\d\*\-,/]+ [\d\*\-,/]+ [\d\*\-,/]+ [\d\*\-,/]+$"
# raw load stamp: local wall clock as %Y%m%d_%H%M%S
LOAD_STAMP_FORMAT = "%Y%m%d_%H%M%S"
# raw text of a timestamp: seconds only when the microseconds are zero, else all six digits
RAW_TS_SECONDS = "yyyy-MM-dd HH:mm:ss"
RAW_TS_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# job name of a source: <source>_job
JOB_SUFFIX = "_job"
