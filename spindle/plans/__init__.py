"""Named queries over the driver's tables (``queries()`` / ``oracle_sql()``)."""

from . import arrivals, core, dirty, fold_queries, ml, models_many, observed, profiling, streams, tables, text_arrays  # noqa: F401  (registration side effects)
from .registry import ORACLE_SQL, QUERIES, SURVEY_IDS

__all__ = ["ORACLE_SQL", "QUERIES", "SURVEY_IDS"]
