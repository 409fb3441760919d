"""Free-text place -> US state code.

Rules (comma-separated parts, trailing empty parts dropped first):

* two parts, second part of trimmed length 2 -> that part (any two
  letters, case kept); trimmed by default, untrimmed with ``trim=False``;
* two parts, second part ``USA`` in any case -> lookup of the first part;
* one part -> lookup of that part;
* anything else, or a lookup miss -> ``UND``.

Lookups use the trimmed, lower-cased name against a 50-entry map literal,
so the function is a pure projection: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.states import UNDEFINED, state_lookup
from .text import java_trim


def _lookup(name: Column) -> Column:
    return F.coalesce(F.try_element_at(state_lookup(), F.lower(java_trim(name))), F.lit(UNDEFINED))


def state_code(place: Column | str, trim: bool = True) -> Column:
    """State code of a place string; NULL only for a NULL place."""
    place = F.col(place) if isinstance(place, str) else place
    parts = F.split(F.regexp_replace(place, r",+\z", ""), ",")
    n = F.size(parts)
    first = parts.getItem(0)
    second = F.try_element_at(parts, F.lit(2))
    second_t = java_trim(second)
    two_letter = second_t if trim else second
    code = (F.when(place.isNull(), F.lit(None).cast("string"))
             .when((n == 2) & (F.length(second_t) == 2), two_letter)
             .when((n == 2) & (F.upper(second_t) == "USA"), _lookup(first))
             .when(n == 1, _lookup(first))
             .otherwise(F.lit(UNDEFINED)))
    return code
