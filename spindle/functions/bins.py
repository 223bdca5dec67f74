"""Binning functions (SCL-03, SCL-04, SCL-05, SCL-06).

All are pure ``Column -> Column`` expressions: they stay inside whole-stage
codegen and push no Python into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the original job's output for right results):
# click-hour bin labels, in order, for hours [0,6) [6,12) [12,18), and the
# label for every other hour (>= 18, negative, or unparsable).
HOUR_BIN_EDGES = [0, 6, 12, 18]
HOUR_BIN_LABELS = ["0-6", "6-12", "12-18"]
HOUR_BIN_DEFAULT = "18-24"

# Violation-time bins.  Two-character hour prefix plus the
# A/P marker select a bin; every other input gets the default bin 3.
#   1: 00 01 02 03 12 with A      4: 12 00 01 02 03 with P
#   2: 04 05 06 07 with A         5: 04 05 06 07 with P
#   3: 08 09 10 11 with A         6: 08 09 10 11 with P
AMPM_HOURS_NIGHT = ["00", "01", "02", "03", "12"]
AMPM_HOURS_EARLY = ["04", "05", "06", "07"]
AMPM_HOURS_LATE = ["08", "09", "10", "11"]
AMPM_DEFAULT_BIN = 3


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_by(x, edges: Sequence[float], labels: Sequence, default) -> Column:
    """Half-open bins ``[edges[i], edges[i+1]) -> labels[i]``; anything else
    (below the first edge, at/after the last edge, null) gets ``default``."""
    x = _col(x)
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def click_hour_bin(hour) -> Column:
    """SCL-04: hour of day -> ``"0-6" | "6-12" | "12-18" | "18-24"``; an unknown
    hour has no bin (null)."""
    hour = _col(hour)
    return F.when(hour.isNotNull(), bin_by(hour, HOUR_BIN_EDGES, HOUR_BIN_LABELS, HOUR_BIN_DEFAULT))


def hour_from_log_line(line) -> Column:
    """SCL-05: the hour in ``"<date> HH:MM..."`` (second space-separated
    field, text before the first ``:``); null when absent or not a number."""
    field = F.try_element_at(F.split(_col(line), " "), F.lit(2))
    return F.substring_index(field, ":", 1).try_cast("int")


def hour_prefix(x) -> Column:
    """SCL-06: first two characters."""
    return F.substring(_col(x), 1, 2)


def last_char_upper(x) -> Column:
    """SCL-06: last character, upper-cased (``''`` for an empty string)."""
    return F.upper(F.right(_col(x), F.lit(1)))


def ampm_time_bin(x, strict: bool = False) -> Column:
    """SCL-03: ``hhmmA`` / ``hhmmP`` text -> bin 1..6, default 3.

    Null or empty text gets the default bin; ``strict=True`` raises instead
    (the original job's behaviour)."""
    x = _col(x)
    hr, period = hour_prefix(x), last_char_upper(x)
    is_a, is_p = period == F.lit("A"), period == F.lit("P")
    out = (F.when(hr.isin(AMPM_HOURS_NIGHT) & is_a, F.lit(1))
           .when(hr.isin(AMPM_HOURS_EARLY) & is_a, F.lit(2))
           .when(hr.isin(AMPM_HOURS_LATE) & is_a, F.lit(3))
           .when(hr.isin(AMPM_HOURS_NIGHT) & is_p, F.lit(4))
           .when(hr.isin(AMPM_HOURS_EARLY) & is_p, F.lit(5))
           .when(hr.isin(AMPM_HOURS_LATE) & is_p, F.lit(6))
           .otherwise(F.lit(AMPM_DEFAULT_BIN)))
    if strict:
        bad = x.isNull() | (F.length(x) == 0)
        out = F.when(bad, F.raise_error(F.lit("time text is null or empty"))).otherwise(out)
    return out


def ampm_text_from_ts(ts) -> Column:
    """``hhmm`` on a 12-hour clock plus ``A``/``P`` from a timestamp, the
    shape of a violation time (used to derive test input from ``events``)."""
    ts = _col(ts)
    return F.concat(F.date_format(ts, "hhmm"), F.substring(F.date_format(ts, "a"), 1, 1))
