"""DataFrame → DataFrame operators."""

from .aggregates import (least_skip_null, ordered_array_agg, ordered_array_by_group,
                         scalar,
                         summary_stats)
from .gaps import distinct_keys, expand_ranges, find_gaps, missing_ids, with_prev
from .incremental import (high_watermark, min_changed_period, observability_restart,
                          replace_keys, restrict_to_batch, since, upsert, with_audit)
from .frames import closed_hours, count_by_key, drop_empty, drop_errors, flatten, settled
from .projection import project
from .joins import count_mismatch, join_file_meta, paginate, pending
from .windows import (conditional_true_event, fill_last, fill_next, latest_by_key, latest_row,
                      rank0)

__all__ = [n for n in dir() if not n.startswith("_")]
