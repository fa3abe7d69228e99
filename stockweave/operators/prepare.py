"""Bucketing, routing, denormalising and checking of the stored tables.

The denormaliser, the rule validator, the threshold and the end-to-end check
have no surviving source, so their semantics are ours.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stockweave import columns as c
from stockweave.sources.tables import location_group


def with_location_group(facts: DataFrame) -> DataFrame:
    return facts.withColumn(c.LOCATION_GROUP, location_group(F.col(c.LOCATION)))


def location_groups(facts: DataFrame) -> DataFrame:
    return facts.select(c.LOCATION_GROUP).distinct()


def table_route(tables: DataFrame, masters: list[str]) -> DataFrame:
    """Master feeds are stored whole, fact feeds by location group."""
    return tables.withColumn("route", F.when(F.col("feed").isin(masters), "master").otherwise("fact"))


def denormalize(snapshot: DataFrame, facts: dict[str, DataFrame], master: DataFrame) -> DataFrame:
    """Snapshot rows with the totals of each fact and the item's master data.

    ``facts``: measure column -> frame of (key, measure), any number of rows per
    key.  All facts are stacked and summed to the key by one aggregate, which combines
    on the map side; one join brings the sums to the snapshot, one the master data.
    """
    stacked = None
    for measure, rows in facts.items():
        part = rows.select(*c.KEY, measure)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    totals = stacked.groupBy(*c.KEY).agg(*(F.sum(measure).alias(measure) for measure in facts))
    panel = snapshot.join(totals, c.KEY, "left").join(master, c.SKU, "left")
    return panel.fillna(0, list(facts))


@dataclass(frozen=True)
class Feeds:
    """What a panel is made of.

    ``snapshot``: one row a key with the day's stock; ``facts``: measure -> rows of (KEY,
    measure), any number a key; ``master``: one row a SKU; ``audits``: (SKU, LOCATION,
    AUDIT_DATE, AUDIT_UNITS), any number a key; ``schedule``: (LOCATION, FIRST_DAY, LAST_DAY)
    of the count periods, which may overlap.  Frames may carry LOCATION_GROUP as a partition.
    """

    snapshot: DataFrame
    facts: dict[str, DataFrame]
    master: DataFrame
    audits: DataFrame
    schedule: DataFrame


def attach_schedule(audits: DataFrame, schedule: DataFrame) -> DataFrame:
    """Audits that fall into a count period of their store.

    Periods and audit days of a store are laid on one line, and the latest end so far tells
    whether a period is open: one window instead of a range join.  It sees one row a store
    and day, however many items were counted; an audit comes back to its day by an equi-join.
    """
    day = F.col("AUDIT_DAY")
    starts = schedule.select(c.LOCATION, F.col("FIRST_DAY").alias("AUDIT_DAY"), "LAST_DAY", F.lit(0).alias("tag"))
    counted = audits.select(c.LOCATION, F.col(c.AUDIT_DATE).alias("AUDIT_DAY")).distinct()
    line = starts.unionByName(counted.withColumns({"LAST_DAY": F.lit(None).cast("date"), "tag": F.lit(1)}))
    so_far = Window.partitionBy(c.LOCATION).orderBy("AUDIT_DAY", "tag").rowsBetween(Window.unboundedPreceding, 0)
    opened = line.withColumn("until", F.max("LAST_DAY").over(so_far)).where((F.col("tag") == 1) & (F.col("until") >= day))
    return audits.join(opened.select(c.LOCATION, day.alias(c.AUDIT_DATE)), [c.LOCATION, c.AUDIT_DATE], "left_semi")


def denormalize_panel(feeds: Feeds, groups: list[int] | None = None, as_of: str | None = None) -> DataFrame:
    """The daily panel of the given location groups (None: all), ready for the audit chain.

    Historical mode takes all days, the daily mode (``as_of``) one.  Both limits go to every
    feed before anything is joined, so that they reach the scans.  Scheduled audits are one
    more fact: all facts are stacked and summed to the key by one aggregate, and joined once.
    """

    def of_scope(df: DataFrame, day: str = c.DATE) -> DataFrame:
        group = F.col(c.LOCATION_GROUP) if c.LOCATION_GROUP in df.columns else location_group(F.col(c.LOCATION))
        df = df if groups is None else df.where(group.isin(groups))
        return df if as_of is None else df.where(F.col(day) == F.to_date(F.lit(as_of)))

    audits = attach_schedule(of_scope(feeds.audits, c.AUDIT_DATE), feeds.schedule)
    facts = {n: of_scope(df) for n, df in feeds.facts.items()}
    facts["AUDITS"] = audits.select(*c.PAIR, F.col(c.AUDIT_DATE).alias(c.DATE), F.lit(1).cast("bigint").alias("AUDITS"))
    facts[c.AUDIT_UNITS] = audits.select(*c.PAIR, F.col(c.AUDIT_DATE).alias(c.DATE), F.col(c.AUDIT_UNITS).cast("bigint"))
    rows = denormalize(of_scope(feeds.snapshot).drop(c.LOCATION_GROUP), facts, feeds.master)
    audited, gross = F.col("AUDITS") > 0, F.col(c.GROSS_SALES)
    price = F.floor(F.try_divide(c.TOTAL_RETAIL, F.when(gross > 0, gross)))
    return rows.withColumns(
        {
            c.LOCATION_GROUP: location_group(F.col(c.LOCATION)),
            c.SALES_UNITS: gross + F.col(c.RETURN_UNITS),
            c.ADJ_UNITS: F.col(c.POS_ADJ) + F.col(c.NEG_ADJ),
            c.UNIT_RETAIL: F.coalesce(price, F.lit(0)).cast("bigint"),
            c.START_TOTAL: F.col(c.BEGIN_SOH) + F.col(c.START_INTRANS),
            c.END_TOTAL: F.col(c.END_SOH) + F.col(c.END_INTRANS),
            c.AUDIT_FLAG: F.when(audited, 1).otherwise(0),
            c.AUDIT_DATE: F.when(audited, F.col(c.DATE)),
            c.AUDIT_UNITS: F.when(audited, F.col(c.AUDIT_UNITS)),
        }
    ).drop("AUDITS")


@dataclass(frozen=True)
class Rule:
    name: str
    passes: str  # SQL predicate; a null result counts as failed


def failed_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each row with the names of the rules it breaks."""
    broken = [
        F.when(F.coalesce(F.expr(r.passes), F.lit(False)), F.lit(None)).otherwise(F.lit(r.name)) for r in rules
    ]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that break no rule: the validator's success output."""
    return checked.where(F.size("failed_rules") == 0).drop("failed_rules")


def error_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("failed_rules") > 0).withColumn(
        "failed_rules", F.array_join("failed_rules", ",")
    )


def rule_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows checked and failed per rule, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(~F.coalesce(F.expr(r.passes), F.lit(False))).alias(r.name) for r in rules),
    )
    pairs = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("n_failed")) for r in rules))
    return counts.select("n_rows", F.inline(pairs)).select("rule", "n_rows", "n_failed")


def validate_once(df: DataFrame, rules: list[Rule], path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, good rows, rows with failed_rules) of one scan.

    One partitioned write divides the rows, and the counts of the report are observed while it
    runs; nothing is shuffled before it, so a task that runs again counts once.  Both results
    are read back from their folder.
    """
    spark = df.sparkSession
    seen = Observation("validation")
    checked = failed_rules(df, rules)
    counts = [F.count_if(F.array_contains("failed_rules", r.name)).alias(f"rule {k}") for k, r in enumerate(rules)]
    observed = checked.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    outcome = F.when(F.size("failed_rules") > 0, "error").otherwise("success")
    observed.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(path)
    found = seen.get
    rows = [(r.name, found["rows"], found[f"rule {k}"]) for k, r in enumerate(rules)]
    report = spark.createDataFrame(rows, "rule string, n_rows long, n_failed long")
    stored = spark.read.schema(f"{_ddl(checked)}, outcome string").parquet(path)
    good, bad = (stored.where(F.col("outcome") == x).drop("outcome") for x in ("success", "error"))
    return report, good.drop("failed_rules"), bad


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def error_threshold(checked: DataFrame, day: str, limit: float) -> DataFrame:
    """Per date: share of failing rows and whether the date may proceed."""
    bad = F.count_if(F.size("failed_rules") > 0)
    return checked.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"), bad.alias("n_failed")).select(
        day,
        "n_rows",
        "n_failed",
        F.when(F.col("n_failed") > F.lit(limit) * F.col("n_rows"), "stop").otherwise("proceed").alias("decision"),
    )


def ledger_gap() -> Column:
    """Closing total minus what the day's movements explain."""
    return (
        F.col(c.END_TOTAL)
        - F.col(c.START_TOTAL)
        - F.col(c.IN_TRANSIT)
        - F.col(c.DSD_UNITS)
        - F.coalesce(F.col(c.AUDIT_UNITS), F.lit(0))
        - F.col(c.ADJ_UNITS)
        + F.col(c.SALES_UNITS)
    )


def panel_reconcile(panel: DataFrame) -> DataFrame:
    """Keys with a null part, a duplicate or an open balance, each with its reason."""
    keyed = panel.groupBy(*c.KEY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.abs(ledger_gap())).alias("open_units")
    )
    null_key = F.greatest(*(F.col(k).isNull().cast("int") for k in c.KEY)) == 1
    reason = (
        F.when(null_key, "null_key").when(F.col("n_rows") > 1, "duplicate_key").when(F.col("open_units") != 0, "open_balance")
    )
    return keyed.withColumn("reason", reason).where(F.col("reason").isNotNull())
