from millrace.functions.parse import (  # noqa: F401
    parse_date,
    parse_number,
    parse_time_text,
    parse_timestamp,
)
from millrace.functions.text import (  # noqa: F401
    base_name,
    dash_date,
    event_id,
    null_tokens,
    qcol,
    split_target,
    text_after,
)
