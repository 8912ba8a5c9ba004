from .sanitize import blank_to_null, parse_event_time, sanitize_double, sanitize_long  # noqa: F401
from .encode import event_json  # noqa: F401
