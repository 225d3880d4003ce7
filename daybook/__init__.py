"""daybook: membership and launcher report operators on Spark DataFrames.

Reports (pure ``DataFrame -> DataFrame`` functions of their inputs and a date):
``plans.members``, ``plans.sales``, ``plans.exposure``, ``plans.heatmap``; jobs
with sources and sinks in ``plans.jobs``. Reusable operators live in
``operators`` and ``functions``.
"""

from .functions.labels import label_map, override
from .functions.metrics import pct_change, ratio, round2
from .operators.cohort import first_seen, first_seen_groups
from .operators.compare import compare_frames, compare_periods
from .operators.flatten import flatten_events
from .operators.rollup import cube_sets, rollup
from .operators.topk import rank_labels, top_k_label_set, top_k_labels

__all__ = [
    "compare_frames", "compare_periods", "cube_sets", "first_seen", "first_seen_groups", "flatten_events",
    "label_map", "override", "pct_change", "rank_labels", "ratio", "rollup", "round2", "top_k_label_set",
    "top_k_labels",
]
