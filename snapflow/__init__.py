"""snapflow: snapshot ETL operators expressed as Spark DataFrame / SQL plans.

Feeds land as all-string staging tables, are cast and conformed with lenient or strict
rules, de-duplicated, enriched, unioned and keyed, and every full snapshot is merged into a
long-lived table that tracks which records are new, updated, unchanged or dropped.
"""

from snapflow.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
__version__ = "0.1.0"
