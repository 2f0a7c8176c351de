import collections
import datetime
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlattice.functions.scalars import (
    absolute_url, any_contains, digits_int, keyword_in_context, localised_date, next_page_url, parsed_timestamp, shortened,
    url_tail_id, url_unquoted,
)
from adlattice.operators import pages
from adlattice.session import scratch_path, shared_dir
from adlattice.sources import archive, snapshots
from adlattice.sources import tables
from adlattice.sources.tables import read_html_files, spread_scan, write_html_files
from adlattice.streaming import feeds, price_watch

DAY = datetime.datetime(2024, 1, 1)


def one(spark, column, *values):
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in rows.select(column).collect()]


def test_scalars(spark):
    assert one(spark, digits_int("x"), "1 234 kr", "kr", "", None, "99999999999") == [1234, None, None, None, None]
    assert one(spark, absolute_url(F.col("x"), "http://b"), "/a", "http://c/a", "a", None) == ["http://b/a", "http://c/a", "a", None]
    current = F.lit("https://h.no:8/s/b?x=1#y")
    assert one(spark, next_page_url("x", current), "?page=2", "/p", "http://z", "q", None) == [
        "https://h.no:8/s/b?page=2", "https://h.no:8/p", "http://z", None, None,
    ]
    assert one(spark, url_tail_id("x"), "http://h/item/12/", "http://h/item/12x", "12", "http://h/12?x=1") == ["12", None, "12", None]
    assert one(spark, url_unquoted("x"), "a%20b+c", "100%", "%C3%A5") == ["a b+c", "100%", "å"]
    assert one(spark, shortened("x", 3), "abc", "abcd") == ["abc", "abc..."]
    assert one(spark, keyword_in_context("x", F.lit(" OSLO "), 3), "i dag er Oslo fin", "oslo", "by") == ["er Oslo fi", "oslo", None]
    items = spark.createDataFrame([(["a", "xCCSy"],), ([],), (None,)], "i array<string>")
    assert [r[0] for r in items.select(any_contains("i", "ccs")).collect()] == [True, False, False]


def test_dates(spark):
    naive = lambda values: [v and v.replace(tzinfo=None) for v in values]
    texts = ("10. august 2025, 21:23", "1. mai 2024", "3. juni 2020, 7:05:09", "3. foo 2020", "31. februar 2020", "x", "2. mai 2020, kl 9", None)
    assert naive(one(spark, localised_date("x"), *texts)) == [
        datetime.datetime(2025, 8, 10, 21, 23), datetime.datetime(2024, 5, 1), datetime.datetime(2020, 6, 3, 7, 5),
        None, None, None, datetime.datetime(2020, 5, 2), None,
    ]
    texts = ("2024-01-02T03:04:05Z", "2024-01-02 03:04", "2024-01-02", "2024-01-02T03:04:05+02:00", "1700000000", "2024", "nope", "")
    assert naive(one(spark, parsed_timestamp("x"), *texts)) == [
        datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2, 3, 4), datetime.datetime(2024, 1, 2),
        datetime.datetime(2024, 1, 2, 1, 4, 5), datetime.datetime(2023, 11, 14, 22, 13, 20), None, None, None,
    ]


CARD = ('<article class="sf-search-ad relative isolate"><a class="sf-search-ad-link" id="search-ad-11" href="/item/11">x</a>'
        '<span class="font-bold t3 inline-block">12 500&nbsp;kr</span><span class="text-caption font-bold inline-block">30 fot <b>1998</b></span></article>')


def test_result_cards_and_gate(spark):
    html = f'<html>{CARD}<article class="relative isolate sf-search-ad"><p>no link</p></article><article class="ad">x</article><a href="?page=3" rel="next">n</a></html>'
    df = spark.createDataFrame([(1, "http://h/s?page=2", html)], "page_id bigint, url string, html string")
    rows = pages.result_cards(df, "http://h", F.lit("2024-01-01").cast("timestamp_ntz")).orderBy("card").collect()
    assert [(r["ad_id"], r["ad_url"], r["price"], r["specs_text"]) for r in rows] == [
        ("11", "http://h/item/11", 12500, "30 fot 1998"), (None, None, None, ""),
    ]
    assert pages.next_pages(df).first()["next_url"] == "http://h/s?page=3"
    gate = pages.page_gate(df).first()
    assert (gate["too_short"], gate["no_markup"], gate["no_item_block"], gate["gated"]) == (True, False, True, True)
    full = spark.createDataFrame([('<div id="mobility-item-page-root"></div>',), ("accept the COOKIE",)], "html string")
    assert [r[0] for r in full.select(pages.looks_gated("html")).collect()] == [False, True]
    marked = df.withColumn("html", F.lit('<dl><dt>a</dt><dt>b</dt></dl><p class="x s-text-subtle">c</p>'))
    counts = {r["marker"]: r["hits"] for r in pages.marker_counts(marked).collect()}
    assert (counts["dl dt"], counts["p.s-text-subtle"], counts["#contact-button-data"]) == (2, 1, 0)


LISTINGS = "ad_id string, ad_url string, price int, specs_text string, scraped_at timestamp"


def test_archive_and_load(spark):
    run = [("1", "/1", 5, "ø", DAY), ("1", "/1b", 6, "b", DAY), ("", "/x", 1, "", DAY), (None, "/y", 1, "", DAY), ("2", None, None, None, DAY)]
    listings = spark.createDataFrame(run, LISTINGS)
    folder = archive.archive_listings(listings, scratch_path(spark, "archive"), "2024-01-01T07:00:00")
    assert folder.endswith("listings-2024-01-01T07-00-00")
    back = archive.read_archive(spark, folder)
    assert sorted(r["specs_text"] or "" for r in back.collect()) == ["", "", "", "b", "ø"]
    path = scratch_path(spark, "staging")
    assert archive.load_staging(back, path, ["price"]) == 2
    assert archive.load_staging(back, path, ["price"]) == 0
    later = listings.withColumn("scraped_at", F.lit(DAY + datetime.timedelta(days=40)))
    assert archive.load_staging(later, path, ["price"]) == 2
    stored = spark.read.parquet(path)
    assert sorted((r["ad_id"], r["price"]) for r in stored.collect()) == [(1, 5), (1, 5), (2, None), (2, None)]


def test_pretty_archive_is_read(spark, tmp_path):
    rows = [{"ad_id": "7", "ad_url": "/7", "price": 1, "specs_text": "å", "scraped_at": "2024-01-01T00:00:00.000Z"}]
    (tmp_path / "run.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False), encoding="utf-8")
    row = archive.typed_listings(archive.read_archive(spark, str(tmp_path / "run.json"), pretty=True)).first()
    assert (row["ad_id"], row["specs_text"]) == (7, "å")


def test_duplicate_details_are_an_error(spark):
    details = spark.createDataFrame([(1, DAY), (2, DAY)], "ad_id bigint, scraped_at timestamp_ntz")
    assert archive.append_details(details, details.where("ad_id = 5")).count() == 2
    with pytest.raises(ValueError):
        archive.append_details(details, details.where("ad_id = 1"))


def test_snapshot_versions(spark):
    root = scratch_path(spark, "versions")
    assert snapshots.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, root)
    snapshots.write_snapshot(spark.range(3), root, 1)
    snapshots.write_snapshot(spark.range(5), root, 2)
    os.makedirs(f"{root}/version=3")  # a write that did not finish
    assert snapshots.versions(spark, root) == [1, 2]
    assert (snapshots.read_snapshot(spark, root).count(), snapshots.read_snapshot(spark, root, 1).count()) == (5, 3)


def test_html_files_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """A table of one large split, with more splits than cores or not, is written by tasks of about as many files as allowed."""
    monkeypatch.setattr(tables, "FILES_PER_TASK", 5)
    pages = spark.range(400).selectExpr("id AS page_id", "concat('<p>', id, '</p>') AS html").repartition(16)
    write_html_files(pages, "page_id", str(tmp_path / "out"))
    files = [f for f in (tmp_path / "out").glob("page_id=*/part-*")]
    per_task = {}
    for f in files:
        per_task[f.name[:10]] = per_task.get(f.name[:10], 0) + 1
    assert len(files) == 400 and max(per_task.values()) <= 20 and len(per_task) > 60
    assert {r["html"] for r in read_html_files(spark, str(tmp_path / "out")).collect()} == {f"<p>{i}</p>\n" for i in range(400)}


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html>\nå</html>", encoding="utf-8")
    row = read_html_files(spark, str(tmp_path)).first()
    assert row["html"] == "<html>\nå</html>" and row["url"].endswith("a.html")


def test_spread_scan_leaves_large_tables_alone(spark):
    assert spread_scan(spark.range(0, 100, 1, 64), "id").rdd.getNumPartitions() == 64
    assert spread_scan(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() > 8


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    """Just the parts of a session that the folder choice looks at."""

    def __init__(self, master, **conf):
        self.sparkContext = Context(master)
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: conf.get("folder", default))})


def test_shared_folder_setting_is_used():
    cluster = Session("spark://host:7077", folder="hdfs:///shared")
    assert shared_dir(cluster) == "hdfs:///shared" == cluster.sparkContext.folder
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        shared_dir(Session("spark://host:7077"))
    assert os.path.isdir(shared_dir(Session("local[2]")))


SNAPSHOTS = "ad_id bigint, price double, scraped_at timestamp_ntz, snapshot_id bigint"


def write_batch(spark, path, rows):
    data = [(i, p, DAY + datetime.timedelta(hours=t), n) for n, (i, p, t) in enumerate(rows)]
    spark.createDataFrame(data, SNAPSHOTS).coalesce(1).write.mode("append").parquet(path)


def changes_of(spark, history):
    rows = feeds.price_changes(spark.read.parquet(history)).collect()
    return sorted(((r["ad_id"], r["old_price"], r["new_price"]) for r in rows), key=str)


def test_late_and_equal_time_rows_change_the_pairs(spark):
    path, root, history, check = (scratch_path(spark, n) for n in ("in", "state", "changes", "check"))
    write_batch(spark, path, [(1, 5.0, 0), (1, 6.0, 2), (1, 6.0, 3), (2, 1.0, 0), (4, 10.0, 0)])
    stream = lambda: feeds.stream_files(spark, path, spark.read.parquet(path).schema, 1)
    feeds.watch_prices(stream(), history, check)
    assert changes_of(spark, history) == [(1, 5.0, 6.0)]
    write_batch(spark, path, [(1, 9.0, 1), (1, None, 4), (1, 7.0, 5), (2, 1.0, 6), (3, 2.0, 6), (4, 20.0, 0)])
    feeds.watch_prices(stream(), history, check)
    feeds.maintain_master(stream(), root, f"{check}-master")
    # The late 9.0 splits a pair; NULL is not reported, the way back from it is; snapshot 5 of listing 4 has the time of 4.
    assert changes_of(spark, history) == [(1, 5.0, 9.0), (1, 9.0, 6.0), (1, None, 7.0), (4, 10.0, 20.0)]
    state = {r["ad_id"]: r["price"] for r in snapshots.read_snapshot(spark, root).collect()}
    assert state == {1: 7.0, 2: 1.0, 3: 2.0, 4: 20.0}
    write_batch(spark, path, [(1, 5.0, 0)])  # a snapshot that is known already
    feeds.watch_prices(stream(), history, check)
    assert len(changes_of(spark, history)) == 4


def test_append_keeps_late_rows(spark):
    path, target, check = (scratch_path(spark, n) for n in ("in", "stored", "check"))
    for rows in ([(1, 5.0, 900), (1, 5.5, 900)], [(1, 4.0, 0), (1, 6.0, 900)]):
        write_batch(spark, path, rows)
        stream = feeds.stream_files(spark, path, spark.read.parquet(path).schema, 1)
        feeds.append_deduplicated(stream, ["ad_id", "scraped_at"], ["snapshot_id"], target, check)
    assert sorted(r["price"] for r in spark.read.parquet(target).collect()) == [4.0, 5.0]


def test_repeated_batch_changes_nothing(spark):
    root = scratch_path(spark, "state")
    rows = [(1, 5.0, 0), (1, 6.0, 2)]
    data = [(i, p, DAY + datetime.timedelta(hours=t), n) for n, (i, p, t) in enumerate(rows)]
    batch = spark.createDataFrame(data, SNAPSHOTS)
    run = feeds.versioned_batches(root, lambda before, rows, number: feeds.newest_prices(before, rows))
    for _ in range(2):
        run(batch, 0)
    assert [r["price"] for r in snapshots.read_snapshot(spark, root).collect()] == [6.0]


@pytest.mark.parametrize("prices", [(10.0, 20.0), (20.0, 10.0)])
def test_price_watch_and_master_do_not_depend_on_arrival(spark, prices):
    """Two rows equal in listing, time and number count with the lowest price, whichever comes first."""
    path, root, history, check = (scratch_path(spark, n) for n in ("in", "state", "changes", "check"))
    for price in prices:
        spark.createDataFrame([(1, price, DAY, 7)], SNAPSHOTS).write.mode("append").parquet(path)
    stream = lambda: feeds.stream_files(spark, path, spark.read.parquet(path).schema, 1)
    feeds.maintain_master(stream(), root, f"{check}-master")
    assert snapshots.read_snapshot(spark, root).first()["price"] == 10.0
    spark.createDataFrame([(1, 20.0, DAY + datetime.timedelta(days=1), 8)], SNAPSHOTS).write.mode("append").parquet(path)
    feeds.watch_prices(stream(), history, check)
    assert changes_of(spark, history) == [(1, 10.0, 20.0)]


def plain_changes(entries):
    """Changes over (time, id, price) entries, equal (time, id) being one with the lowest price."""
    once = {}
    for time, number, price in entries:
        once.setdefault((time, number), []).append(price)
    rows = [(t, n, min((p for p in ps if not np.isnan(p)), default=np.nan)) for (t, n), ps in sorted(once.items())]
    return sorted((n, before[2], now[2]) for before, now in zip(rows, rows[1:]) for n in [now[1]] if not np.isnan(now[2]) and before[2] != now[2])


@pytest.mark.parametrize("leaf", [2, 5, 1024])
def test_sorted_snapshots_in_any_order(monkeypatch, leaf):
    """The ledger of any order of arrival, cut into any batches, leaves the changes over the whole log."""
    monkeypatch.setattr(price_watch, "LEAF", leaf)
    draw = np.random.default_rng(leaf)
    for _ in range(40):
        size = int(draw.integers(1, 40))
        rows = np.empty(size, price_watch.ENTRY)
        rows["time"], rows["id"] = draw.integers(0, 15, size), draw.integers(0, 3, size)
        rows["price"] = draw.choice([1.0, 2.0, 3.0, np.nan], size)
        stored, ledger = {}, collections.Counter()
        for part in np.array_split(rows, int(draw.integers(1, 6))):
            if len(part):
                new, _ = price_watch.merged(np.zeros(0, price_watch.ENTRY), part)
                for entries, old, sign in price_watch.SortedSnapshots(stored.get, stored.__setitem__).add(new):
                    for entry, before in zip(entries, old, strict=True):
                        ledger[(int(entry["time"]), int(entry["id"]), str(before), float(entry["price"]))] += sign
        assert set(ledger.values()) <= {0, 1}
        have = sorted((n, b, p) for (_, n, b, p), count in ledger.items() if count)
        assert have == sorted((n, str(b), p) for n, b, p in plain_changes(rows.tolist()))
        leaves = [v for k, v in stored.items() if k >= 0] if stored[-1][:1] == b"I" else [stored[-1][1:]]
        sizes = [len(np.frombuffer(v, price_watch.ENTRY)) for v in leaves]
        assert max(sizes) <= leaf and sum(sizes) == len(set(zip(rows["time"].tolist(), rows["id"].tolist())))
