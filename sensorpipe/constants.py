"""Names and codes shared by all operators."""

# Quality codes of the canonical format.
OK = 0
MISSING = 1
SPIKE = 2
OUT_OF_RANGE = 3
DISCONNECTED = 4
INTERPOLATED = 5
CORRECTED = 6

# Text forms of times, the "no bound" placeholder of a configured range, null on CSV.
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
NO_BOUND = "yyyy-mm-ddTh:m:sZ"
CSV_NULL = "NaN"

# Column orders of the long frames.
CANONICAL = ["ts", "device_id", "metric", "value", "unit", "domain", "quality_flag"]
RESAMPLED = CANONICAL + ["is_interpolated", "gap_duration"]
SINK_LONG = ["ts", "device_id", "domain", "sensor", "value"]
RAW_LONG = ["Time", "device_id", "sensor", "value"]
