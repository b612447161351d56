"""Joins of many rows with a short list, on a key of which some values may be most of the rows.

Which values these are is measured: a heavy-hitter sketch of the key, of bounded size, in one pass that reads only the
key. Rows of a heavy value are split into as many parts as its share of all rows asks for, and the list's entry of that
value, and no other, is repeated for each part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that the sketch reports, and counters it keeps to find them.
HEAVY, TRACKED = 64, 8192
#: Parts that all rows of a table would be split into: a value with a third of the rows gets a third of them.
SPREAD = 1024


@dataclass(frozen=True)
class HeavyKeys:
    """The parts of each value that is split, by the hash of its key columns."""

    keys: tuple[str, ...]
    parts: dict[int, int] = field(default_factory=dict)

    def _parts(self) -> Column:
        if not self.parts:
            return F.lit(1)
        entries = F.create_map(*[F.lit(x) for pair in sorted(self.parts.items()) for x in pair])
        return F.coalesce(F.try_element_at(entries, _hash(self.keys)), F.lit(1))

    def split(self, rows: DataFrame, by: Sequence[str], part: str = "part") -> DataFrame:
        """``rows`` with the part they are in; rows of a heavy value are dealt by the columns ``by``."""
        return rows.withColumn(part, F.pmod(F.xxhash64(*by), self._parts()))

    def repeated(self, entries: DataFrame, part: str = "part") -> DataFrame:
        """``entries`` once for each part of their value."""
        parts = F.sequence(F.lit(0).cast("long"), self._parts().cast("long") - 1)
        return entries.withColumn(part, F.explode(parts))


def _hash(keys: Sequence[str]) -> Column:
    # values of equal hash are split alike, which harms nothing
    return F.xxhash64(*keys)


def heavy_keys(rows: DataFrame, keys: Sequence[str], spread: int = SPREAD) -> HeavyKeys:
    """The values of ``keys`` in ``rows`` that hold more than a part in ``spread`` of them."""
    sketch = F.call_function("approx_top_k", F.col("_key"), F.lit(HEAVY), F.lit(TRACKED)).alias("top")
    found = rows.select(_hash(keys).alias("_key")).agg(sketch, F.count("*").alias("n")).first()
    counts = {r["item"]: r["count"] for r in found.top or []}
    parts = {key: -(-count * spread // found.n) for key, count in counts.items()}
    return HeavyKeys(tuple(keys), {key: n for key, n in parts.items() if n > 1})
