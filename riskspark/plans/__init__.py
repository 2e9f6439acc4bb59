"""Plans that need care at scale: ordered running sums, exact quantiles, exact cuts."""

from riskspark.plans.cuts import HashCut, below_cut, hash_cut_table, lowest_hash_cuts, with_cut_table
from riskspark.plans.ordered import (
    SKETCH_SHARE, Sketch, as_literal, exact_quantiles, ordered_cumsum, sketch, split_points, with_bucket,
)

__all__ = [
    "HashCut", "SKETCH_SHARE", "Sketch", "as_literal", "below_cut", "exact_quantiles", "hash_cut_table", "lowest_hash_cuts", "ordered_cumsum",
    "sketch", "split_points", "with_bucket", "with_cut_table",
]
