"""Domain operators: ``DataFrame -> DataFrame`` functions (and Column builders)."""

from blendwise.operators.allocate import (
    allocate_fee, days_in_period, share_of_total, split_spend, video_masks,
)
from blendwise.operators.attribution import (
    attribute_measures, join_spend_to_touch, linear_attribution, lookback, map_utm, skan_offset,
    touch_orders, trial_revenue,
)
from blendwise.operators.blend import (
    active_rows, align_to, app_blend, campaign_dimension, full_outer, full_outer_blend,
    regional_paid_spend, soft_delete, split_channels, stack, stack_channels, stack_relations,
    store_block,
)
from blendwise.operators.blend import split_channels as split_account_channels
from blendwise.operators.calendar import cap_at, cutover, granularity_rollup, spine, spine_join
from blendwise.operators.classify import (
    acquisition_spend, bucket_exact, classify, label_unpaid, normalise_channel, repair_names,
)
from blendwise.operators.commerce import (
    net_new, order_counts, period_refund, product_units, returning_orders, sales_components,
)
from blendwise.operators.distinct import dense_ids, distinct_rollup
from blendwise.operators.joins import days_of_periods, gap_fill, reduce_to, split_full_outer
from blendwise.operators.scenario import goal_rollup, stack_scenarios, unpivot_regions
from blendwise.operators.funnel import crm_funnel, new_vs_recurring, platform_plus_crm, web_sessions
