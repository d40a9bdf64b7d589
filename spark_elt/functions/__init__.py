"""Column expressions (F01–F20). All are built-in Spark expressions: no Python UDF,
so they stay inside whole-stage code generation."""

from spark_elt.functions.durations import (  # noqa: F401
    epoch_seconds,
    format_duration,
    format_duration_ms,
    format_time_difference,
)
from spark_elt.functions.paths import (  # noqa: F401
    empty_path,
    last_name,
    path_has_prefix,
    path_text,
    relative_label,
)
from spark_elt.functions.text import (  # noqa: F401
    clean_message,
    day_id,
    format_labels,
    iso_timestamp,
    mask_secrets,
    sanitize_id,
    status_text,
    truncate_text,
    usage_ratio,
)
