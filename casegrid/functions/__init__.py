"""Column -> Column building blocks (all JVM-side, codegen-friendly)."""

from casegrid.functions.clean import (  # noqa: F401
    PANDAS_NULL_TOKENS,
    cast_int,
    cast_round,
    clean_text,
    null_tokens,
    trim_to_null,
)
from casegrid.functions.keys import content_hash, surrogate_key  # noqa: F401
from casegrid.functions.lookup import (  # noqa: F401
    bucketize,
    census_region,
    coarse_event_from_category,
    coarse_event_from_code,
    map_code,
    naics_sector,
    outcome_label,
    ownership_label,
)
from casegrid.functions.parse import (  # noqa: F401
    render_sas_date,
    render_sas_timestamp,
    sas_date,
    sas_timestamp,
)
