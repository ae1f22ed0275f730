"""Plan shapes shared by the operators: durable cuts, salting, prefix sums."""

from .durable import checkpointed, checkpointed_by, release
from .prefix import first_of_each, running_before, with_positions, with_score_block
from .rows import explode_counts, explode_once
from .skew import hot_keys, salt_many, salt_one, salted_join
from .staging import Staging, shared_folder
from .stripes import to_stripes

__all__ = [
    "Staging", "checkpointed", "checkpointed_by", "explode_counts",
    "explode_once", "first_of_each", "hot_keys", "release", "running_before", "salt_many", "salt_one", "salted_join", "shared_folder",
    "to_stripes", "with_positions", "with_score_block",
]
