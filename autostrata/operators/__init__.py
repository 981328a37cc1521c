from autostrata.operators.keys import dense_key, range_key
from autostrata.operators.lookup import distinct_values, unique_lookup
from autostrata.operators.matching import closest_names

__all__ = ["closest_names", "dense_key", "distinct_values", "range_key", "unique_lookup"]
