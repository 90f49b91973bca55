"""Column-expression functions (all JVM-side, whole-stage-codegen friendly)."""

from rentrisk.functions.dates import (  # noqa: F401
    age_years,
    clean_dob,
    date_parts,
    parse_local_date,
    require_date,
    time_suffix,
)
from rentrisk.functions.amounts import default_amount, payment_amount  # noqa: F401
from rentrisk.functions.hashing import hash60, hash_unit, key_string  # noqa: F401
