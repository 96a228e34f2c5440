from gridpulse.operators.dedup import dedup_batch, first_per_group
from gridpulse.operators.histories import HISTORY_LIMIT, histories
from gridpulse.operators.layout import cluster_layout, partition_layout, zorder_layout
from gridpulse.operators.nearest import nearest_per_group
from gridpulse.operators.quality import Expectations, Rule
from gridpulse.operators.star import star_join

__all__ = [
    "HISTORY_LIMIT",
    "Expectations",
    "Rule",
    "cluster_layout",
    "dedup_batch",
    "first_per_group",
    "histories",
    "nearest_per_group",
    "partition_layout",
    "star_join",
    "zorder_layout",
]
