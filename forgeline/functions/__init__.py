from forgeline.functions.scalar import (  # noqa: F401
    canonical_json,
    defect_rate,
    duration_hours,
    integer_text_nonpositive,
    integer_text_ok,
    integer_text_value,
    is_blank,
    is_plain_timestamp,
    machine_day_key,
    ntz_lit,
    parse_quantity,
    parse_timestamp,
    plain_timestamp,
    quantity_is_integer,
    quantity_is_nonpositive,
    quantity_text,
    row_json,
    row_reference,
    safe_ratio,
    unicode_decimal_digits,
)
