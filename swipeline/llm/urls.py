"""URL filters: captures against list entries that were active when they were fetched.

Dated changes of a list (an entry is added or removed on a day) become validity intervals; an as-of
join finds the entries whose interval holds the day of the fetch. Only Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """The lower-cased host: without scheme, user, port and a leading ``www.``; null if there is none."""
    after = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    authority = F.regexp_extract(after, r"^//([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(authority), r"^.*@", ""), r":[0-9]*$", "")
    bare = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"\.+$", "")
    return F.when(bare != "", bare)


def domains_of(host: Column) -> Column:
    """The host and the domains above it that have a dot; the host alone if it has none."""
    labels = F.split(host, r"\.")
    levels = F.greatest(F.size(labels) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), levels), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(changes: DataFrame) -> DataFrame:
    """(list_name, domain, valid_from, valid_to): when each entry was active, the end exclusive.

    ``changes`` has list_name, domain, day and action ('add' or 'remove'). Of changes of an entry on
    one day a removal wins; repeated ones count once; changes with a null are dropped. An entry added
    twice stays active; a removal of what is not there does nothing. Touching intervals are one.
    """
    known = changes.where("list_name is not null and domain is not null and day is not null and action in ('add', 'remove')")
    entry = Window.partitionBy("list_name", "domain").orderBy("day")
    state = known.groupBy("list_name", F.lower("domain").alias("domain"), "day").agg(
        (F.max("action") == "add").alias("active")
    )
    turned = state.withColumn("was", F.coalesce(F.lag("active").over(entry), F.lit(False))).where("active <> was")
    closed = turned.withColumn("valid_to", F.coalesce(F.lead("day").over(entry), F.lit(FOREVER).cast("date")))
    return closed.where("active").select("list_name", "domain", F.col("day").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(host, fetched, lists, entry): for each host and day its active lists, and the longest domain that matched.

    Hosts with no active entry are not in the result. A host fetched often on a day is looked up
    once: captures are grouped before the join, so a host with a third of all captures is a row a day.
    """
    asked = captures.where("host is not null and fetched is not null").select("host", "fetched").distinct()
    levels = asked.withColumn("domain", F.explode(domains_of(F.col("host"))))
    in_force = (F.col("fetched") >= F.col("valid_from")) & (F.col("fetched") < F.col("valid_to"))
    return (
        levels.join(entries, "domain")
        .where(in_force)
        .groupBy("host", "fetched")
        .agg(
            F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("lists"),
            F.max_by("domain", F.length("domain")).alias("entry"),
        )
    )


def filter_urls(pages: DataFrame, changes: DataFrame) -> DataFrame:
    """page_id, host, fetched, blocked, lists and entry of every row of ``pages`` (page_id, url, fetched).

    A row whose url has no host, or without a day, is not blocked; lists and entry are null where
    nothing is active. Repeated rows count each; empty tables of changes block nothing; other columns
    are not read.
    """
    captures = pages.select("page_id", host_of(F.col("url")).alias("host"), "fetched")
    found = active_entries(captures, intervals(changes))
    # Hosts with an active entry; a hot host has one row a day here, so only the captures are skewed,
    # and those Spark splits.
    return captures.join(found, ["host", "fetched"], "left").select(
        "page_id", "host", "fetched", F.col("lists").isNotNull().alias("blocked"), "lists", "entry"
    )
