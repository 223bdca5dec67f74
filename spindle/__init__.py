"""spindle: Spark-native data operators for tables and streams.

The most used entry points are re-exported here; every module documents
its operators with the SURVEY ids they implement.
"""

from .operators.clean import (PARKING_SPEC, CleanSpec, clean, dedup, drop_columns,
                              drop_null_heavy, fill_defaults, iqr_filter)
from .operators.metrics import accuracy_f1
from .operators.profile import (boxplot_stats, duplicate_keys, frequency, frequency_many,
                                histogram, null_nan_counts, quartiles, summary, top_k_per_group)
from .operators.quantile import approx_quantiles, exact_quantiles
from .operators.split import hash_split, random_split
from .session import get_spark, scratch_path, shared_dir

__version__ = "0.1.0"

__all__ = [
    "PARKING_SPEC", "CleanSpec", "clean", "dedup", "drop_columns", "drop_null_heavy",
    "fill_defaults", "iqr_filter", "accuracy_f1", "boxplot_stats", "duplicate_keys",
    "frequency", "frequency_many", "histogram", "null_nan_counts", "quartiles", "summary",
    "top_k_per_group", "approx_quantiles", "exact_quantiles", "hash_split", "random_split",
    "get_spark", "scratch_path", "shared_dir",
]
