"""Column functions: ``f(col, ...) -> Column``, built-ins only."""

from martforge.functions.buckets import (age_group, age_group2, case, default, null_if,
                                         sla_bucket)
from martforge.functions.coerce import coerce
from martforge.functions.text import (bool_text, clean_text, flag_text, full_name, json_int,
                                      json_pick, json_struct, json_text, map_status, norm_accession,
                                      num_or, scalar_text, split_pick_int, storage_urls,
                                      strip_html, tag_texts, to_str, to_text, unescape_html,
                                      yes_no)
from martforge.functions.time import (clamp_ts, date_or_floor, fix_sec60, fmt_ts, hhmmss,
                                      hms, hours_floor, latest_of, local_date,
                                      minute_boundaries, minutes_elapsed, minutes_float,
                                      open_end, parse_ts, plus_hours, secs, to_local,
                                      wall_time)

__all__ = [n for n in dir() if not n.startswith("_")]
