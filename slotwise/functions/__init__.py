from slotwise.functions.columns import (  # noqa: F401
    as_timestamp,
    category_position,
    channel_of,
    day_name,
    employee_id,
    exact_sum,
    guarded_ratio,
    invitee_id_of,
    iso_local_text,
    iso_utc_text,
    quoted,
)
