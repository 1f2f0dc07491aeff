from tillstream.functions.scalars import (
    age_band, age_years, exact_sum, mask_phone, pct, pct_text, to_number,
)
from tillstream.functions.text import any_term, all_terms, keyword_terms, tokens
from tillstream.functions.times import (
    current_day, day_of, hour_of, minute_doc_id, ms_to_time, prev_day, with_create_parts, with_log_parts,
)

__all__ = [
    "age_band", "age_years", "exact_sum", "mask_phone", "pct", "pct_text", "to_number",
    "any_term", "all_terms", "keyword_terms", "tokens",
    "current_day", "day_of", "hour_of", "minute_doc_id", "ms_to_time", "prev_day",
    "with_create_parts", "with_log_parts",
]
