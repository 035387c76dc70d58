from barline.functions.columns import (  # noqa: F401
    cell_text,
    count_where,
    decimal_text,
    flag,
    hex_slice_value,
    is_missing,
    log_return,
    minute_floor,
    parse_bar_time,
    ratio_or_zero,
    round_places,
    row_text,
    safe_div,
    zscore_or_zero,
)
