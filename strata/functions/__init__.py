"""Column expressions (``Column → Column``) used by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from strata.functions.text import (  # noqa: F401
    digits_and_plus, leading_number, proper_case, split_labelled, split_route, trimmed_extract,
)
from strata.functions.casts import flag, null_if_equal, safe_cast, safe_to_date  # noqa: F401
from strata.functions.derive import (  # noqa: F401
    bucketize, guarded_rate, minutes_between, pct, row_hash, safe_ratio, stay_days,
)
