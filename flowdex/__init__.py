"""flowdex: feeds of text messages -> analyzers -> search-index documents, on Spark.

The names below are the public entry points; the query catalog used by the
benchmark and the oracle checks lives in :mod:`flowdex.plans.catalog`.
"""

from flowdex.plans.analyzers import HistogramAnalyzer, SqlAnalyzer, apply_analyzer
from flowdex.session import build_session, configure, named_dir, work_dir
from flowdex.streaming.runner import start_indexing, trigger_of

__all__ = ["HistogramAnalyzer", "SqlAnalyzer", "apply_analyzer", "build_session", "configure",
           "named_dir", "work_dir", "start_indexing", "trigger_of"]
