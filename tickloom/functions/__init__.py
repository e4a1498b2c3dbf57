from tickloom.functions.clock import (  # noqa: F401
    bucket_floor,
    local_day,
    ns_to_local,
    ns_to_timestamp,
    ns_to_utc,
    session_bounds,
)
from tickloom.functions.flow import ofi_ratio, side_sign, vwap  # noqa: F401
from tickloom.functions.vectors import (  # noqa: F401
    canonical_hash,
    feature_vector,
    json_hash,
    message,
)
