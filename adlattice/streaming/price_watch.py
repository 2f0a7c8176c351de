"""Price watch on keyed state: every listing keeps its snapshots as a sorted map, so a late one touches two neighbours only.

The map of a listing is cut into leaves of at most ``LEAF`` snapshots, with an index of their first and last ones. A micro-batch reads and
writes the leaves that its snapshots fall into, and nothing else of what came before; a listing that holds a large part of
all snapshots has many leaves, of which a batch touches few. Listings are handled in groups by a hash of their id.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Keyed state needs the store that keeps maps on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Snapshots of a leaf, and groups that listings are dealt into.
LEAF = 1024
GROUPS = 64

ENTRY = np.dtype([("time", "<i8"), ("id", "<i8"), ("price", "<f8")])  # a missing price is NaN
INDEX = np.dtype([("leaf", "<i4"), ("first", ENTRY), ("last", ENTRY)])
CHANGES = "ad_id long, snapshot_id long, time long, old_price double, new_price double, sign int"


def merged(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of both in order, and the place of each old one; equal (time, id) are one entry with the lowest price."""
    both = np.concatenate((old, new))
    order = np.lexsort((both["id"], both["time"]))
    both = both[order]
    first = np.ones(len(both), bool)
    first[1:] = (both["time"][1:] != both["time"][:-1]) | (both["id"][1:] != both["id"][:-1])
    starts = np.flatnonzero(first)
    out = both[starts].copy()
    out["price"] = np.fmin.reduceat(both["price"], starts)
    place = np.empty(len(both), np.int64)
    place[order] = np.cumsum(first) - 1
    return out, place[: len(old)]


def previous_prices(entries: np.ndarray, before: np.void | None) -> tuple[np.ndarray, np.ndarray]:
    """The price before each entry, and whether the entry reports a change: it has a price, and one before it that differs."""
    previous = np.concatenate(([np.nan if before is None else before["price"]], entries["price"][:-1]))
    # NaN differs from every price, so a price after a missing one is a change; the very first entry has none before it.
    reported = ~np.isnan(entries["price"]) & (previous != entries["price"])
    if before is None:
        reported[0] = False
    return previous, reported


class SortedSnapshots:
    """The leaves of one listing. ``read`` and ``write`` reach its stored parts by number.

    Part -1 is the index, or, as long as there is only one leaf, that leaf itself: most listings are read and written once.
    """

    def __init__(self, read, write):
        self.read, self.write = read, write
        stored = read(-1)
        self.only = np.frombuffer(stored[1:], ENTRY) if stored is not None and stored[:1] == b"L" else None
        if self.only is not None:
            self.index = np.array([(0, self.only[0].item(), self.only[-1].item())], INDEX)
        else:
            self.index = np.frombuffer(stored[1:], INDEX) if stored is not None else np.zeros(0, INDEX)

    def _leaf(self, number: int) -> np.ndarray:
        return self.only if self.only is not None else np.frombuffer(self.read(number), ENTRY)

    def add(self, new: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Store snapshots (sorted, one per time and id) and return (entries, old prices, sign) of changes gone and come."""
        firsts = list(zip(self.index["first"]["time"].tolist(), self.index["first"]["id"].tolist(), strict=True))
        keys = zip(new["time"].tolist(), new["id"].tolist(), strict=True)
        leaf_of = np.array([max(bisect.bisect_right(firsts, key) - 1, 0) for key in keys])
        out: list[tuple[np.ndarray, np.ndarray, int]] = []
        made, rows, next_leaf = [], [], int(self.index["leaf"].max()) + 1 if len(self.index) else 0
        before_old = before_new = None  # the entry in front of the leaf, as it was and as it is now
        for number in range(max(len(self.index), 1)):
            known = self.index[number] if len(self.index) else None
            own = new[leaf_of == number]
            if len(own):
                old = self._leaf(int(known["leaf"])) if known is not None else np.zeros(0, ENTRY)
                entries, place = merged(old, own)
                self._compare(out, old, before_old, entries, place, before_new)
                for start in range(0, len(entries), max(LEAF // 2, 1)) if len(entries) > LEAF else [0]:
                    part = entries[start : start + LEAF // 2] if len(entries) > LEAF else entries
                    leaf = int(known["leaf"]) if known is not None and start == 0 else next_leaf
                    next_leaf += leaf == next_leaf
                    made.append((leaf, part))
                    rows.append((leaf, part[0], part[-1]))
                before_old, before_new = (old[-1] if len(old) else before_old), entries[-1]
            else:
                if before_old is not before_new:
                    one = np.array([known["first"]], ENTRY)
                    self._compare(out, one, before_old, one, np.array([0]), before_new)
                rows.append((known["leaf"], known["first"], known["last"]))
                before_old = before_new = known["last"]
        if len(rows) == 1:
            self.write(-1, b"L" + made[0][1].tobytes())
            return out
        for leaf, part in made:
            self.write(leaf, part.tobytes())
        index = np.array([(leaf, first.item(), last.item()) for leaf, first, last in rows], INDEX)
        self.write(-1, b"I" + index.tobytes())
        return out

    @staticmethod
    def _compare(out: list, old: np.ndarray, before_old, entries: np.ndarray, place: np.ndarray, before_new) -> None:
        previous, reported = previous_prices(entries, before_new)
        come = reported.copy()
        if len(old):
            was, had = previous_prices(old, before_old)
            same = (had == reported[place]) & (~had | (
                (old["price"] == entries["price"][place]) & ((was == previous[place]) | (np.isnan(was) & np.isnan(previous[place])))))
            out.append((old[had & ~same], was[had & ~same], -1))
            come[place] &= ~same
        out.append((entries[come], previous[come], 1))


class PriceWatch(StatefulProcessor):
    """Changes that the snapshots of a batch bring about, per group of listings."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getMapState("parts", "ad_id long, part int", "data binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One chunk of rows at a time; the result does not depend on how they are cut.
        for chunk in rows:
            yield from self._changes(chunk)

    def _changes(self, chunk: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ads = chunk["ad_id"].to_numpy(np.int64)
        entries = np.empty(len(chunk), ENTRY)
        entries["time"], entries["id"], entries["price"] = chunk["time"], chunk["snapshot_id"], chunk["price"].to_numpy(np.float64)
        order = np.argsort(ads, kind="stable")
        ads, entries = ads[order], entries[order]
        starts = np.flatnonzero(np.concatenate(([True], ads[1:] != ads[:-1])))
        found, owner = [], []
        for start, end in zip(starts, [*starts[1:], len(ads)], strict=True):
            ad = int(ads[start])
            new, _ = merged(np.zeros(0, ENTRY), entries[start:end])
            for part in SortedSnapshots(lambda n, ad=ad: self._read(ad, n), lambda n, data, ad=ad: self._write(ad, n, data)).add(new):
                if len(part[0]):
                    found.append(part)
                    owner.append(ad)
        if found:
            rows, sizes = np.concatenate([f[0] for f in found]), [len(f[0]) for f in found]
            yield pd.DataFrame({
                "ad_id": np.repeat(owner, sizes), "snapshot_id": rows["id"], "time": rows["time"],
                "old_price": np.concatenate([f[1] for f in found]), "new_price": rows["price"],
                "sign": np.repeat(np.array([f[2] for f in found], np.int32), sizes),
            })

    def _read(self, ad: int, part: int) -> bytes | None:
        value = self.parts.getValue((ad, part))
        return None if value is None else bytes(value[0])

    def _write(self, ad: int, part: int, data: bytes) -> None:
        self.parts.updateValue((ad, part), (data,))

    def close(self) -> None:
        pass


def price_change_stream(snapshots: DataFrame) -> DataFrame:
    """Stream of changes (ad_id, snapshot_id, changed_at, old_price, new_price, sign) from a stream of snapshots in any order.

    ``sign`` is 1, or -1 for a change that was reported before and no longer holds, as a late snapshot stands between its two. A
    missing price is remembered but not reported. Snapshots equal in listing, time and number are one, with the lowest
    price, whichever comes first. Rows without listing, time or number are left out. The session's state store must be ``STATE_STORE``.
    """
    keys = ["ad_id", "scraped_at", "snapshot_id"]
    rows = snapshots.dropna(subset=keys).select(
        F.pmod(F.xxhash64("ad_id"), F.lit(GROUPS)).cast("int").alias("listing_group"), F.col("ad_id").cast("long").alias("ad_id"),
        F.unix_micros(F.col("scraped_at").cast("timestamp")).alias("time"), F.col("snapshot_id").cast("long").alias("snapshot_id"),
        F.col("price").cast("double").alias("price"))
    found = rows.groupBy("listing_group").transformWithStateInPandas(PriceWatch(), CHANGES, "Append", "None")
    missing = lambda c: F.when(~F.isnan(c), F.col(c)).cast(snapshots.schema["price"].dataType)
    return found.select(
        "ad_id", "snapshot_id", F.timestamp_micros("time").cast(snapshots.schema["scraped_at"].dataType).alias("changed_at"),
        missing("old_price").alias("old_price"), missing("new_price").alias("new_price"), "sign")
