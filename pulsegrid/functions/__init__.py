"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from pulsegrid.functions.nulls import (  # noqa: F401
    all_present, any_missing, null_count, not_equal_null_aware, share_true,
    skipnull_sum, strict_sum,
)
from pulsegrid.functions.numeric import (  # noqa: F401
    corrected_kurtosis, corrected_skewness, guarded_cv, half_even, safe_div,
)
from pulsegrid.functions.timeparts import (  # noqa: F401
    day_part, hour_of_day, timestamp_from_offset, weekend_flag,
)
