"""Two copies of a panel compared by a tree of digests.

A row's digest is a hash of all its columns; a day's is the sum of its rows' digests and
their number, and a location group's that of its days: sums, so the order of rows and the way
they are stored do not matter.  Both copies are compared from the top: the days of a group
are looked at only if the groups differ, the rows of a day only if the days do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.sources.shared import written


def day_digests(panel: DataFrame) -> DataFrame:
    """(LOCATION_GROUP, DATE, n_rows, digest): one aggregate, combined on the map side.  Two
    hashes of different seeds make the digest; a null is told from any value."""
    rest = sorted(n for n in panel.columns if n not in (c.LOCATION_GROUP, c.DATE))
    values = [x for n in rest for x in (F.col(n).isNull(), F.col(n))]
    hashes = [F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)") for seed in (1, 2)]
    return panel.groupBy(c.LOCATION_GROUP, c.DATE).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(hashes[0]).alias("digest"), F.sum(hashes[1]).alias("digest_2")
    )


DIGEST = ["n_rows", "digest", "digest_2"]


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests are not the same on both sides, or that one side lacks."""
    a, b = (x.select(*keys, F.struct(*DIGEST).alias(side)) for x, side in ((left, "a"), (right, "b")))
    return a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)


def panel_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(KEY, LOCATION_GROUP, kind, fields): keys that only one side has (``left_only``,
    ``right_only``) or whose rows differ (``changed``, with the names of the fields).

    Both have the same columns, unique keys and LOCATION_GROUP, by which they may be stored:
    only the folders of differing groups are read again.  A row that changed its group shows
    in both groups and comes out as changed.
    """
    days = [written(day_digests(x), "digests") for x in (left, right)]
    sums = [F.sum(n).alias(n) for n in DIGEST]
    groups = _differing(*(d.groupBy(c.LOCATION_GROUP).agg(*sums) for d in days), [c.LOCATION_GROUP])
    wanted = [r[0] for r in groups.collect()]  # location groups: as many as there are folders

    def narrow(x: DataFrame) -> DataFrame:
        own = F.col(c.LOCATION_GROUP)
        inside = own.isin([w for w in wanted if w is not None])
        return x.where(inside | own.isNull() if None in wanted else inside)

    changed = _differing(*(narrow(d) for d in days), [c.LOCATION_GROUP, c.DATE]).select(c.DATE).distinct()
    changed = written(changed, "days")
    fields = [n for n in left.columns if n not in c.KEY]
    sides = []
    for x, side in ((left, "a"), (right, "b")):
        rows = narrow(x).join(changed, c.DATE, "left_semi")
        sides.append(rows.select(*c.KEY, F.struct(*fields).alias(side)))
    joined = sides[0].join(sides[1], c.KEY, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    names = F.array_compact(
        F.array(*(F.when(~F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")), F.lit(n)) for n in fields))
    )
    kind = F.when(F.col("b").isNull(), "left_only").when(F.col("a").isNull(), "right_only").otherwise("changed")
    return joined.select(
        *c.KEY,
        F.coalesce(F.col(f"a.{c.LOCATION_GROUP}"), F.col(f"b.{c.LOCATION_GROUP}")).alias(c.LOCATION_GROUP),
        kind.alias("kind"),
        F.when(kind == "changed", F.array_join(names, ",")).otherwise("").alias("fields"),
    )
