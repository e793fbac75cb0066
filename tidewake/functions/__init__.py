from tidewake.functions.scalars import (  # noqa: F401
    age_on,
    any_of,
    as_date,
    hours_until,
    map_text,
    money,
    on_date,
    on_dates,
    ratio_pct,
    voyage_length_days,
    zero_if_null,
)
