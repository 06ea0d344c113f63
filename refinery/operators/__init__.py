from refinery.operators.merge import late_arrivals, merge_unique, upsert
from refinery.operators.ranges import range_join
from refinery.operators.ranking import latest_per_key, top_n, top_n_per_group
from refinery.operators.rejects import REASON, accepted, label_rejects, rejected, require_fields
from refinery.operators.shares import share_of_total
from refinery.operators.timeline import as_of_join, history
from refinery.operators.versions import apply_rows, diff_keys, diff_rows

__all__ = [
    "REASON",
    "accepted",
    "apply_rows",
    "as_of_join",
    "diff_keys",
    "diff_rows",
    "history",
    "label_rejects",
    "late_arrivals",
    "latest_per_key",
    "merge_unique",
    "range_join",
    "rejected",
    "require_fields",
    "share_of_total",
    "top_n",
    "top_n_per_group",
    "upsert",
]
