"""Snapshots to current state: crawl candidates, master merge, price history, deactivation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlattice.functions.scalars import first_year, is_changed, is_stale, share_of_ids
from adlattice.operators.keyed import latest_per_key, previous_per_key
from adlattice.schemas import DETAIL_COLUMNS

# Order columns of a snapshot log: scrape time, then the load id that breaks ties.
SNAPSHOT_ORDER = ["scraped_at", "snapshot_id"]


def latest_snapshot(staging: DataFrame) -> DataFrame:
    """Newest search snapshot of every listing."""
    order = [c for c in SNAPSHOT_ORDER if c in staging.columns]
    return latest_per_key(staging, "ad_id", order)


def cleaned_listings(staging: DataFrame) -> DataFrame:
    """Snapshots with id and price, plus the first four-digit run of the specs as ``extracted_year``."""
    return staging.where(F.col("price").isNotNull() & F.col("ad_id").isNotNull()).withColumn(
        "extracted_year", first_year("specs_text")
    )


def new_listings(latest: DataFrame, ads: DataFrame) -> DataFrame:
    """Listings that are not in the master yet."""
    return latest.join(ads.select("ad_id"), "ad_id", "left_anti")


def price_differs(old: Column, new: Column, sentinel: int | None = None) -> Column:
    """Null-safe price change; with ``sentinel`` NULL and that price count as equal."""
    if sentinel is None:
        return is_changed(old, new)
    return F.coalesce(old, F.lit(sentinel)) != F.coalesce(new, F.lit(sentinel))


def price_changed(latest: DataFrame, ads: DataFrame, sentinel: int | None = None) -> DataFrame:
    """Listings whose newest price differs from the master, with old and new price."""
    old = ads.select("ad_id", F.col("latest_price").alias("old_price"))
    both = latest.select("ad_id", F.col("price").alias("new_price"), "scraped_at").join(old, "ad_id")
    return both.where(price_differs(F.col("old_price"), F.col("new_price"), sentinel))


def stale_listings(ads: DataFrame, as_of: Column, age: str = "24 hours") -> DataFrame:
    """Active listings not refreshed within ``age`` before ``as_of``."""
    return ads.where(F.col("active") & is_stale("last_scraped_at", as_of, age))


def sampled_listings(ads: DataFrame, share: float = 0.05) -> DataFrame:
    """A repeatable sample of the active listings."""
    return ads.where(F.col("active") & share_of_ids("ad_id", share))


def crawl_candidates(
    staging: DataFrame, ads: DataFrame, as_of: Column, age: str = "24 hours", share: float = 0.05
) -> DataFrame:
    """Every listing due for a detail fetch, once, with all reasons: new, price, stale, sample.

    One full outer join of the newest snapshots with the master answers the four questions together,
    so neither table is read or shuffled more than once.
    """
    latest = latest_snapshot(staging).select("ad_id", "price", F.lit(True).alias("in_snapshot"))
    master = ads.select("ad_id", "latest_price", "last_scraped_at", "active", F.lit(True).alias("in_master"))
    both = latest.join(master, "ad_id", "full_outer")
    known, seen = F.col("in_master").isNotNull(), F.col("in_snapshot").isNotNull()
    live = known & F.coalesce("active", F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(seen & ~known, "new"),
            F.when(seen & known & is_changed(F.col("latest_price"), F.col("price")), "price"),
            F.when(live & is_stale("last_scraped_at", as_of, age), "stale"),
            F.when(live & share_of_ids("ad_id", share), "sample"),
        )
    )
    return both.select("ad_id", reasons.alias("reasons")).where(F.size("reasons") > 0)


def incoming_listings(staging: DataFrame, details: DataFrame) -> DataFrame:
    """Newest snapshot of every listing with its newest details, in the master's column names."""
    fields = [c for c in [*DETAIL_COLUMNS, "equipment"] if c in details.columns]
    order = [c for c in SNAPSHOT_ORDER if c in details.columns]
    newest_details = latest_per_key(
        details.select("ad_id", *order, *fields, F.col("source_json").alias("source_raw")), "ad_id", order
    ).drop(*order)
    seen = F.col("scraped_at")
    return (
        latest_snapshot(staging)
        .select(
            "ad_id",
            "ad_url",
            F.col("price").alias("latest_price"),
            seen.alias("first_seen_at"),
            seen.alias("last_seen_at"),
            seen.alias("last_scraped_at"),
            F.lit(True).alias("active"),
        )
        .join(newest_details, "ad_id", "left")
    )


# Merge policy by column: what a matched master row takes over from the incoming row.
OVERWRITE = ["ad_url", "latest_price", "last_seen_at", "last_scraped_at", "active"]
KEEP_OLD_IF_NULL = [*DETAIL_COLUMNS, "equipment", "source_raw"]


def merge_by_policy(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    overwrite: list[str],
    keep_if_null: list[str] = (),
    on_insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Upsert ``new`` into ``old`` as one full outer join, giving the next snapshot of the table.

    Both sides must be unique on ``keys``. Columns in ``overwrite`` always take the new value,
    columns in ``keep_if_null`` only a non-null one; all other columns keep the old value on a match
    and take the new one (or ``on_insert``) on an insert.
    """
    on_insert = on_insert or {}
    old_side = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("__old"))
    new_side = new.select(*keys, F.struct(*[c for c in new.columns if c not in keys]).alias("__new"))
    matched_new = F.col("__new").isNotNull()
    inserted = F.col("__old").isNull()

    def merged(name: str) -> Column:
        before = F.col("__old")[name]
        if name in on_insert:
            before = F.when(inserted, on_insert[name]).otherwise(before)
        if name not in new.columns:
            return before.alias(name)
        after = F.col("__new")[name]
        if name in overwrite:
            return F.when(matched_new, after).otherwise(before).alias(name)
        if name in keep_if_null:
            return F.coalesce(after, before).alias(name)
        return F.when(inserted, after).otherwise(before).alias(name)

    both = old_side.join(new_side, keys, "full_outer")
    return both.select(*[c if c in keys else merged(c) for c in old.columns])


def merge_master(ads: DataFrame, staging: DataFrame, details: DataFrame) -> DataFrame:
    """Next version of the master after a crawl.

    A new listing starts with first and last seen at its newest scrape; a known one keeps
    ``first_seen_at`` and any detail the new snapshot lacks.
    """
    return merge_by_policy(
        ads,
        incoming_listings(staging, details),
        ["ad_id"],
        OVERWRITE,
        KEEP_OLD_IF_NULL,
        {"has_embeddings": F.lit(False)},
    )


def price_history_rows(staging: DataFrame, ads_before: DataFrame, with_initial: bool = False) -> DataFrame:
    """History rows to append: price changes against the master **before** the merge.

    A change to NULL is not logged. The first price of a new listing is logged only on request.
    """
    latest = latest_snapshot(staging).where(F.col("price").isNotNull())
    changed = price_changed(latest, ads_before).select(
        "ad_id", F.col("new_price").alias("price"), F.col("scraped_at").alias("changed_at")
    )
    if not with_initial:
        return changed
    first = new_listings(latest, ads_before).select("ad_id", "price", F.col("scraped_at").alias("changed_at"))
    return changed.unionByName(first)


def price_changes_log(staging: DataFrame) -> DataFrame:
    """Every price change over the whole snapshot log, with the price before it."""
    columns = staging.select("ad_id", "scraped_at", "snapshot_id", "price").withColumn("seen", F.struct("price"))
    previous = previous_per_key(columns, "ad_id", "scraped_at", "snapshot_id", "seen", "before")
    return previous.where(
        F.col("before").isNotNull() & F.col("price").isNotNull() & is_changed(F.col("before.price"), F.col("price"))
    ).select("ad_id", F.col("before.price").alias("old_price"), F.col("price").alias("new_price"),
             F.col("scraped_at").alias("changed_at"))


def seen_listings(staging: DataFrame, scope: str = "all", since: Column | None = None,
                  run_length: str = "6 hours") -> DataFrame:
    """Ids that count as still listed.

    ``all``: anywhere in the log; ``since``: scraped at or after a time; ``last_run``: within
    ``run_length`` before the newest scrape in the log.
    """
    if scope == "all":
        rows = staging
    elif scope == "since":
        rows = staging.where(F.col("scraped_at") >= since)
    elif scope == "last_run":
        # One value, found first, so that the filter can reach the scan.
        newest = staging.agg(F.max("scraped_at")).first()[0]
        rows = staging.where(F.col("scraped_at") >= F.lit(newest).cast(staging.schema["scraped_at"].dataType) - F.expr(f"INTERVAL {run_length}"))
    else:
        raise ValueError(f"unknown scope {scope!r}")
    return rows.select("ad_id").distinct()


def disappeared_listings(ads: DataFrame, seen: DataFrame) -> DataFrame:
    """Active listings that are no longer seen."""
    return ads.where("active").join(seen, "ad_id", "left_anti")


def deactivate_disappeared(ads: DataFrame, seen: DataFrame) -> DataFrame:
    """Next version of the master with disappeared listings set inactive."""
    marked = ads.join(seen.select("ad_id", F.lit(True).alias("__seen")), "ad_id", "left")
    return marked.withColumn("active", F.col("active") & F.col("__seen").isNotNull()).drop("__seen")


def deactivate_gone(ads: DataFrame, gone: DataFrame) -> DataFrame:
    """Set listings reported as gone inactive; ``newly_inactive`` tells which were still active."""
    hit = ads.join(gone.select("ad_id").distinct().withColumn("__gone", F.lit(True)), "ad_id", "left")
    newly = F.col("active") & F.col("__gone").isNotNull()
    return hit.withColumn("newly_inactive", newly).withColumn(
        "active", F.col("active") & F.col("__gone").isNull()
    ).drop("__gone")


def snapshot_to_master(ads: DataFrame, staging: DataFrame, details: DataFrame, scope: str = "all",
                       since: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One full run: the merged and deactivated master, and the history rows to append."""
    history = price_history_rows(staging, ads)
    merged = merge_master(ads, staging, details)
    return deactivate_disappeared(merged, seen_listings(staging, scope, since)), history
