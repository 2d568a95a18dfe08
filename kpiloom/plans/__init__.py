"""Plan shapes for the few analyses where the default plan does not scale:
order statistics, ntile and global ranks without a sort of the table, top-k
per group (no whole group in one task), and interval bins (no nested-loop join)."""

from kpiloom.plans.bins import count_in_bins  # noqa: F401
from kpiloom.plans.selection import at_ranks, dense_rank, exact_percentiles, ntiles, ordered_cuts  # noqa: F401
from kpiloom.plans.topk import top_k_distinct_per_group  # noqa: F401
