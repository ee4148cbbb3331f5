from crewcast.functions.dates import (
    add_month_steps, folder_of, local_date, local_datetime, month_of, month_sequence, parse_month_label, week_ending_monday,
)
from crewcast.functions.keys import row_fingerprint, series_identifier
from crewcast.functions.text import (
    any_like, first_match, joined_parts, mentions, recode,
)
from crewcast.functions.values import child_or_parent, flag_to_int, guarded_ratio, renamed_key, repaired

__all__ = [
    "add_month_steps", "any_like", "child_or_parent", "first_match", "flag_to_int", "folder_of", "guarded_ratio", "joined_parts",
    "local_date", "local_datetime", "mentions", "month_of", "month_sequence", "parse_month_label", "recode",
    "renamed_key", "repaired", "row_fingerprint", "series_identifier", "week_ending_monday",
]
