"""File catalogue and intake quality, on one row per dropped file.

Rows are (path, name).  The reference feeds are a short fixed list, so matching
a file against them is a filter over a literal array: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.sources.shared import written

# Feed names, extensions, date formats and holidays of the intake.
REQUIRED_FEEDS = ["FD_STORE_INV"]
OTHER_FEEDS = [
    "FD_SALES",
    "FD_CARRIER_DETAILS",
    "FD_SKU_MASTER",
    "FD_RETURNS",
    "FD_PHYSICAL_INVENTORY_COUNT_SCHEDULE",
    "FD_INV_ADJ",
    "FD_PHYSICAL_INV_ADJUSTMENTS",
    "FD_STORE_TRANSFERS_IN",
    "FD_DSD_INVOICE",
]
FEEDS = REQUIRED_FEEDS + OTHER_FEEDS
EXTENSIONS = ["csv", "gz"]
NAME_DATE_FORMATS = ["ddMMyyyy", "yyyyMMdd"]
HOLIDAYS = ["20230704", "20230702"]
LOG_DATE = "yyyyMMdd"
COMPONENT = "Data Ingestion"
LOG_COLUMNS = [
    "sub_proc_id", "run_id", "task_id", "component", "run_date", "file_date", "status",
    "priority", "error_code", "error_message", "missed_files", "processed_files",
    "unpermitted_files", "extra",
]
ERROR_MESSAGES = {
    "DATA_ING_ERR_001": "All Files missed for the day",
    "DATA_ING_ERR_002": "Mandatory files missed for the day",
}


def _literals(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def stem(name: Column) -> Column:
    return F.element_at(F.split(name, "\\."), 1)


def extension(name: Column) -> Column:
    return F.element_at(F.split(name, "\\."), -1)


def file_parse(files: DataFrame) -> DataFrame:
    """Feed token and date token of each name; names without a date token drop out."""
    parts = F.split("name", "-|\\.")
    return files.where(F.size(parts) > 1).select(
        "path", "name", F.element_at(parts, 1).alias("feed"), F.element_at(parts, 2).alias("date_token")
    )


def name_matches(name: Column, feed: Column) -> Column:
    """<feed>-<8 digits>-<digits>, extension apart.  Stated in two halves because the feed is a
    column: the constant half is compiled once, a pattern built per row would not be."""
    rest = F.substring(stem(name), F.length(feed) + F.lit(1), F.length(name))
    return stem(name).startswith(feed) & rest.rlike("^-[0-9]{8}-[0-9]+$")


def file_pattern(files: DataFrame, feeds: list[str] = FEEDS) -> DataFrame:
    """The feed whose naming pattern each file follows, if any."""
    hit = F.filter(_literals(feeds), lambda feed: name_matches(F.col("name"), feed))
    # null when no feed matches
    return files.withColumn("pattern_feed", F.get(hit, 0))


def file_extension(files: DataFrame, allowed: list[str] = EXTENSIONS) -> DataFrame:
    """Strict check of the live path and the case-blind one of the former path."""
    ext = extension(F.col("name"))
    return files.withColumns(
        {
            "extension": ext,
            "permitted": ext.isin(allowed).cast("int"),
            "permitted_any_case": F.lower(ext).isin(allowed).cast("int"),
        }
    )


def matched_feeds(files: DataFrame, feeds: list[str] = FEEDS) -> DataFrame:
    """One row per file and feed whose name occurs in the path; a file without any
    stays with a null feed."""
    hits = F.filter(_literals(feeds), lambda feed: F.contains(F.col("path"), feed))
    return files.select("*", F.explode_outer(hits).alias("feed"))


def matched_by_table(files: DataFrame, feeds: DataFrame, q: int = 6, broadcast_chars: int = 500_000) -> DataFrame:
    """``matched_feeds`` against a table (feed) of any size, through an index of q-grams.

    Each feed is entered under one of its q-grams, the one that fewest paths hold (the whole
    feed, if it is shorter), and each path is looked up under all of its own: an equi-join in
    place of a comparison of all pairs.  What meets is compared; a pair meets once.  An empty
    or null feed matches nothing; a null path has no feed.

    Both joins state their form: Spark takes the grams of the paths for as small as the paths
    themselves and would broadcast them.  The feeds are measured: up to ``broadcast_chars`` in all
    their grams go to the paths, beyond that both sides are dealt out by gram.
    """
    wanted = written(feeds.where(F.length("feed") > 0).select("feed").distinct(), "feeds")
    grams = lambda x, n: F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substring(x, i, F.lit(n)))
    # at most q lengths
    lengths = wanted.groupBy(F.least(F.length("feed"), F.lit(q))).agg(F.sum(F.length("feed"))).collect()
    if not lengths:
        return files.withColumn("feed", F.lit(None).cast("string"))
    sizes = [r[0] for r in lengths]
    form = "broadcast" if sum(r[1] for r in lengths) <= broadcast_chars else "merge"
    held = own = None
    for n in sizes:
        long = files.where(F.length("path") >= n).select("*", F.explode(F.array_distinct(grams(F.col("path"), n))).alias("__gram"))
        held = long if held is None else held.unionByName(long)
        part = wanted.where(F.least(F.length("feed"), F.lit(q)) == n).select("feed", F.explode(grams(F.col("feed"), n)).alias("__gram"))
        own = part if own is None else own.unionByName(part)
    met = held.select("__gram").join(own.select("__gram").distinct().hint(form), "__gram", "left_semi")
    often = met.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    counted = own.join(often.hint(form), "__gram", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    anchors = counted.groupBy("feed").agg(F.min(F.struct("__n", "__gram"))["__gram"].alias("__gram"))
    found = written(held.join(anchors.hint(form), "__gram").where(F.contains("path", F.col("feed"))).select(*files.columns, "feed"), "found")
    rest = files.join(found.select("path").distinct(), "path", "left_anti").select(*files.columns, F.lit(None).cast("string").alias("feed"))
    return found.unionByName(rest)


def file_classify(files: DataFrame) -> DataFrame:
    """all_valid, valid_name (bad extension) or file_name_error per file and feed."""
    matched = matched_feeds(files)
    good_name = F.coalesce(name_matches(F.col("name"), F.col("feed")), F.lit(False))
    good_ext = extension(F.col("name")).isin(EXTENSIONS)
    status = (
        F.when(good_name & good_ext, "all_valid")
        .when(good_name, "valid_name")
        .otherwise("file_name_error")
    )
    return matched.select(
        "path",
        "name",
        F.when(good_name, F.col("feed")).otherwise("").alias("feed"),
        F.when(good_name, F.element_at(F.split(stem(F.col("name")), "-"), 2)).otherwise("").alias("file_date"),
        status.alias("status"),
    )


def file_route(classified: DataFrame, success: str, error: str) -> DataFrame:
    """Target path of every classified file."""
    good, bad = F.lit(success.rstrip("/")), F.lit(error.rstrip("/"))
    target = (
        F.when(F.col("status") == "all_valid", F.concat_ws("/", good, "feed", "name"))
        .when(F.col("status") == "valid_name", F.concat_ws("/", bad, F.lit("extension_error"), "feed", "name"))
        .otherwise(F.concat_ws("/", bad, F.lit("file_name_error"), "name"))
    )
    return classified.withColumn("target", target)


def file_table_groups(routed: DataFrame) -> DataFrame:
    """Accepted files by the directory they were routed to: one row per directory and file."""
    return routed.where(F.col("status") == "all_valid").select(
        F.element_at(F.split("target", "/"), -2).alias("directory"), "target"
    )


def received_by_date(parsed: DataFrame) -> DataFrame:
    """Distinct feed tokens received under each date token: one row per pair, since tokens come
    from arbitrary file names."""
    return parsed.select("date_token", "feed").distinct()


def missing_feeds(parsed: DataFrame, required: list[str] = REQUIRED_FEEDS) -> DataFrame:
    """(date_token, feed) rows that were expected and not received."""
    expected = parsed.select("date_token").distinct().select(
        "date_token", F.explode(_literals(required)).alias("feed")
    )
    received = parsed.select("date_token", "feed").distinct()
    return expected.join(received, ["date_token", "feed"], "left_anti")


def missing_mandatory(parsed: DataFrame, required: list[str] = REQUIRED_FEEDS) -> DataFrame:
    """Required feeds absent under each date token, "None" when complete.

    One aggregate: the list of required feeds is the literal, minus those seen.
    """
    wanted = _literals(required)
    seen = F.collect_set(F.when(F.col("feed").isin(required), F.col("feed")))
    missing = F.array_join(F.array_sort(F.array_except(wanted, F.col("seen"))), ",")
    return parsed.groupBy("date_token").agg(seen.alias("seen")).select(
        "date_token", F.when(missing == "", "None").otherwise(missing).alias("missing")
    )


def match_date_formats(files: DataFrame, dates: DataFrame) -> DataFrame:
    """Files belonging to each date: the name contains it in an accepted format.

    Every 8-digit run of a name is cut out and joined on equality, which reaches
    the same pairs as testing all dates against all names.
    """
    # the look-ahead yields every position, overlapping runs included
    runs = F.array_distinct(F.regexp_extract_all("name", F.lit("(?=([0-9]{8}))"), F.lit(1)))
    tokens = files.select("path", "name", F.explode(runs).alias("token"))
    spelled = dates.select(
        "file_date",
        F.explode(F.array_distinct(F.array(*(F.date_format("file_date", f) for f in NAME_DATE_FORMATS)))).alias("token"),
    )
    return tokens.join(spelled, "token").select("file_date", "path", "name").distinct()


def date_gap_fill(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two date sets; when both hold dates, every day from first to last."""
    column = "file_date"
    span = first.select(column, F.lit(1).alias("__side")).unionByName(
        second.select(column, F.lit(2).alias("__side"))
    )
    # the set of distinct days is bounded by the calendar
    ends = span.agg(
        F.min(column).alias("low"),
        F.max(column).alias("high"),
        F.count_distinct("__side").alias("sides"),
        F.collect_set(column).alias("days"),
    )
    days = F.when(F.col("sides") == 2, F.sequence("low", "high")).otherwise(F.col("days"))
    return ends.select(F.explode(days).alias(column))


def exclude_holidays(dates: DataFrame, holidays: list[str] = HOLIDAYS) -> DataFrame:
    return dates.where(~F.date_format("file_date", LOG_DATE).isin(holidays))


def date_min_max(dates: DataFrame) -> DataFrame:
    return dates.agg(F.max("file_date").alias("max_date"), F.min("file_date").alias("min_date"))


def last_run_rows(log: DataFrame, component: str = COMPONENT, priorities=("critical",)) -> DataFrame:
    """Log rows of one component and priority at its latest run date."""
    rows = log.where((F.col("component") == component) & F.col("priority").isin(*priorities))
    latest = rows.agg(F.max(F.to_date("run_date", LOG_DATE)).alias("__latest"))
    return rows.join(
        F.broadcast(latest), F.to_date("run_date", LOG_DATE) == F.col("__latest")  # one row
    ).drop("__latest")


def missing_from_log(rows: DataFrame) -> DataFrame:
    """Distinct (date, missed feed) rows, read from the list cells of a log."""
    cell = F.regexp_replace("missed_files", "[\\[\\]' ]", "")
    return rows.select("file_date", F.explode(F.split(cell, ",")).alias("feed")).where("feed != ''").distinct()


def missing_reconcile(pairs: DataFrame) -> DataFrame:
    """(date, feed) pairs on one side only; empty when the two agree.

    Pairs come tagged with in_input and in_log, a pair any number of times: one aggregate
    serves both sides.
    """
    sides = pairs.groupBy("file_date", "feed").agg(
        F.bool_or("in_input").alias("in_input"), F.bool_or("in_log").alias("in_log")
    )
    return sides.where(F.col("in_input") != F.col("in_log")).select(
        "file_date", "feed", F.when(F.col("in_input"), "input").otherwise("log").alias("only_in")
    )


def day_files(files: DataFrame) -> DataFrame:
    """Files of each date with every feed they match and whether the extension passes."""
    permitted = F.lower(extension(F.col("name"))).isin(EXTENSIONS)
    return matched_feeds(files).withColumn("permitted", permitted)


def day_route(day: DataFrame, dates: DataFrame, required: list[str] = REQUIRED_FEEDS) -> DataFrame:
    """Success for a date with all required feeds, otherwise error for the whole day.

    Every date of ``dates`` has a row; one without any file goes to error.
    """
    got = F.count_distinct(F.when(F.col("permitted") & F.col("feed").isin(required), F.col("feed")))
    seen = day.groupBy("file_date").agg(got.alias("got"))
    missing = F.lit(len(required)) - F.coalesce("got", F.lit(0))
    return dates.select("file_date").join(seen, "file_date", "left").select(
        "file_date", missing.alias("n_missing"), F.when(missing == 0, "success").otherwise("error").alias("route")
    )


def intake_log(
    day: DataFrame, dates: DataFrame, run_date: str, run: tuple = ("1", "2", "3"), required=REQUIRED_FEEDS
) -> DataFrame:
    """Log rows per date of ``dates``: an error when required feeds are missing, a success when
    any file was processed; a date may have both, one without any file has the error that
    all are missing.

    Processed feeds are listed with their file counts, which keeps the cell as
    short as the list of feeds.
    """
    per_feed = day.groupBy("file_date", "feed").agg(
        F.sum(F.col("permitted").cast("bigint")).alias("n")
    )
    processed = F.when(F.col("feed").isNotNull() & (F.col("n") > 0), F.concat_ws(":", "feed", F.col("n").cast("string")))
    present = F.when(F.col("n") > 0, F.col("feed"))
    seen = per_feed.groupBy("file_date").agg(
        F.array_join(F.array_sort(F.collect_list(processed)), ",").alias("processed"),
        F.collect_set(present).alias("present"),
    )
    none = F.array().cast("array<string>")
    days = dates.select("file_date").join(seen, "file_date", "left").select(
        "file_date",
        F.coalesce("processed", F.lit("")).alias("processed"),
        F.array_sort(F.array_except(_literals(required), F.coalesce("present", none))).alias("missed"),
    )
    n_missed = F.size("missed")
    code = F.when(n_missed == len(required), "DATA_ING_ERR_001").otherwise("DATA_ING_ERR_002")
    errors = days.where(n_missed > 0).select(
        "file_date",
        F.lit("failed").alias("status"),
        F.lit("critical").alias("priority"),
        code.alias("error_code"),
        F.when(n_missed == len(required), ERROR_MESSAGES["DATA_ING_ERR_001"])
        .otherwise(ERROR_MESSAGES["DATA_ING_ERR_002"]).alias("error_message"),
        F.array_join("missed", ",").alias("missed_files"),
        F.lit("").alias("processed_files"),
    )
    blank = F.lit("")
    good = days.where(F.col("processed") != "").select(
        "file_date", F.lit("success").alias("status"), blank.alias("priority"), blank.alias("error_code"),
        blank.alias("error_message"), blank.alias("missed_files"),
        F.col("processed").alias("processed_files"),
    )
    return as_log(errors.unionByName(good), run_date, run)


def unpermitted_log(day: DataFrame, run_date: str, run: tuple = ("1", "2", "3")) -> DataFrame:
    """Failed/moderate rows, one per date, feed and file with a forbidden extension."""
    bad = day.where(~F.col("permitted") & F.col("feed").isNotNull())
    rows = bad.select(
        "file_date", F.lit("failed").alias("status"), F.lit("moderate").alias("priority"), F.col("name").alias("unpermitted_files")
    )
    return as_log(rows, run_date, run)


def as_log(rows: DataFrame, run_date: str, run: tuple) -> DataFrame:
    """The 14 text columns of the log, absent cells empty."""
    fixed = dict(zip(("sub_proc_id", "run_id", "task_id"), run)) | {"component": COMPONENT, "run_date": run_date}
    cells = []
    for name in LOG_COLUMNS:
        if name in fixed:
            cells.append(F.lit(fixed[name]).alias(name))
        elif name == "file_date":
            cells.append(F.date_format("file_date", LOG_DATE).alias(name))
        else:
            cells.append((F.col(name) if name in rows.columns else F.lit("")).alias(name))
    return rows.select(*cells)


def legacy_file_route(day: DataFrame, out: str) -> DataFrame:
    """{out}/{date}/{feed}/{file} for every feed a file of the date matches."""
    date = F.date_format("file_date", LOG_DATE)
    return day.where("permitted and feed is not null").select(
        "file_date", "name", "feed",
        F.concat_ws("/", F.lit(out.rstrip("/")), date, "feed", "name").alias("target"),
    )


def relative_date(as_of: Column, offset: Column) -> Column:
    """as_of moved by offset days; a positive offset counts as_of as its first day."""
    return F.date_add(as_of, F.when(offset > 0, offset - 1).otherwise(offset).cast("int"))


def strip_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))
