"""Scalar functions: every one returns a built-in Catalyst expression (no Python UDF)."""

from .events import (canonical_event, event_to_family, is_time_event, normalise_season_label,
                     season_label_id, season_label_order, window_label_id)
from .keys import athlete_key, event_key, family_key, next_season_key, season_key
from .marks import (fmt_dist, fmt_time, is_finite, mark_to_numeric, parse_date,
                    parse_distance_to_meters, parse_float, parse_time_like,
                    parse_time_to_seconds, submitted_mark, submitted_wind, wind_mps)
from .text import (division_from_text, gender_from_url, pystrip, slug,
                   team_and_gender_from_title, url_has_required_query, url_query_param,
                   visible_text)

__all__ = [n for n in dir() if not n.startswith("_")]
