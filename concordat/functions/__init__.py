"""Column expressions: everything stays inside whole-stage code generation."""

from concordat.functions.codes import (  # noqa: F401
    attrition_rate,
    embedded_number,
    lenient_number,
    pct2,
    ratio2,
    zero_pad_code,
)
from concordat.functions.dates import (  # noqa: F401
    date_of,
    date_or_null,
    day_delta,
    epoch_ms_parts,
    interval_hms,
    iso_date,
    run_date,
    token_date,
)
from concordat.functions.text import (  # noqa: F401
    contact_to_email,
    email_domain,
    extract_emails,
    identity_key,
    is_blank,
    is_risky_domain,
    is_valid_email,
    normalize_email,
    normalize_text,
    origin_class,
    squeeze,
)
