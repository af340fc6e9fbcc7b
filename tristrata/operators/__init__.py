"""DataFrame-to-DataFrame operators, independent of any particular table."""

from tristrata.operators.calendar import calendar, calendar_covering
from tristrata.operators.combos import conformed_combinations, smallest_value_per_key
from tristrata.operators.conform import Contract, conform, pack_and_expand
from tristrata.operators.history import apply_snapshot, as_of_join, version_dimension
from tristrata.operators.latest import first_per_key, latest_keys, latest_per_key
from tristrata.operators.star import measure_by_dimension, star_join

__all__ = [
    "Contract",
    "apply_snapshot",
    "as_of_join",
    "calendar",
    "calendar_covering",
    "conform",
    "conformed_combinations",
    "first_per_key",
    "latest_keys",
    "latest_per_key",
    "measure_by_dimension",
    "pack_and_expand",
    "smallest_value_per_key",
    "star_join",
    "version_dimension",
]
