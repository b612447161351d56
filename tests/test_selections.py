"""The latest record per tag in several selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.operators.inventory import Selection, latest_by_selection
from tests.test_fanout import AS_OF
from tests.test_shared_tables import sources


def test_a_record_of_several_selections_is_one_row(spark):
    src = sources(spark)
    chosen = [Selection(m, w) for m in (False, True) for w in (False, True)]
    flagged = latest_by_selection(src, AS_OF, ["owner_id"], chosen)
    labels = [s.label for s in chosen]
    assert all(flagged.schema[x].dataType.typeName() == "boolean" for x in labels)
    got = flagged.select("tag_key", *[F.col(f"`{x}`").cast("int").alias(f"n{i}") for i, x in enumerate(labels)])
    sums = got.groupBy("tag_key").sum().collect()
    assert sums and all(max(r[1:]) == 1 for r in sums)
    assert flagged.count() < sum(sum(r[1:]) for r in sums)
