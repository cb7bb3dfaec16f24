from quarry.functions.scalar import (  # noqa: F401
    floor_div,
    interval_micros,
    l2_distance,
    lsn_diff,
    lsn_to_bytes,
    micros_between,
    round_ratio,
    round_to_second,
    seconds_between,
    whole_seconds_between,
    xid_age,
)
