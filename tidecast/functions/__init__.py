"""Column-level helpers built from Spark SQL built-ins (no Python UDFs)."""

from tidecast.functions.scalars import (  # noqa: F401
    area_token,
    fold_of,
    guarded_ratio,
    hours_between,
    id_date,
    id_store_key,
    lead_hours_mod24,
    rounded,
    weekday0,
)
