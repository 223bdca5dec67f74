"""Scalar ``Column -> Column`` functions (SCL-*)."""

from .bins import (ampm_text_from_ts, ampm_time_bin, bin_by, click_hour_bin,
                   hour_from_log_line, hour_prefix, last_char_upper)
from .dates import date_parts, format_us_date, parse_us_date
from .structured import (argmax, chw_to_hwc, file_name, file_stem, is_malformed_json,
                         label_from_path, lookup, normalise_channels, parse_json,
                         row_to_json, weighted_position_sum)
from .text import (split_line_count, text_file_line_count, utf8_text, word_count,
                   word_tokens)

__all__ = [
    "ampm_text_from_ts", "ampm_time_bin", "bin_by", "click_hour_bin",
    "hour_from_log_line", "hour_prefix", "last_char_upper", "date_parts",
    "format_us_date", "parse_us_date", "argmax", "chw_to_hwc", "file_name",
    "file_stem", "is_malformed_json", "label_from_path", "lookup",
    "normalise_channels", "parse_json", "row_to_json", "weighted_position_sum",
    "split_line_count", "text_file_line_count", "utf8_text", "word_count",
    "word_tokens",
]
