from custodia.functions.exprs import (  # noqa: F401
    age_hours,
    code_label,
    date_attributes,
    duration_minutes,
    iso_timestamp,
    json_number,
    mask_email,
    pass_fail,
    pct,
    row_hash,
    score_band,
    to_document,
)
from custodia.functions.similarity import (  # noqa: F401
    blended_confidence,
    indel_ratio,
    jaro_winkler,
    matching_blocks_ratio,
    name_signals,
)
from custodia.functions.text import normalize_place, normalize_party  # noqa: F401
