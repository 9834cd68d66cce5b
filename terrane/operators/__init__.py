"""Dataset operators: each takes DataFrames and returns a lazy DataFrame."""

from .clean import (
    clean_transactions, customer_master, dedupe_latest, latest_by_key, new_rows_only, replace_by_key,
    revenue_summary,
)
from .inventory import (
    inventory_position, inventory_status, level_at_sale, movement_ledger, product_master,
)
from .joins import salted_left_join
from .keybits import key_bits, mark_possible, merged_bits, new_rows_by_bits, slots_for
from .link import link_entities
from .marts import (
    activity_counts, fact_sales, fact_screenings, sales_by_name, screening_rollup,
    screening_totals, segment_customers, segment_summary, stale_screenings,
    title_features, top_entities,
)
from .quality import (
    QualityError, dq_report, duplicate_keys, enforce, enforce_counts, gate_no_nulls, gate_non_empty,
    null_counts, passed, quarantine, tag_rows, warn_checks,
)
from .running import running_by_chunk
from .scd2 import (
    Scd2Columns, closure_updates, hash_diff_append, hash_diff_refresh, scd2_apply, scd2_history, scd2_merge,
    scd2_snapshot,
)

__all__ = [name for name in dir() if not name.startswith("_")]
