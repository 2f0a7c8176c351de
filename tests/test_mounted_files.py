"""Pages in a mounted folder are written by the tasks, as Spark's writer lays them out."""

import pytest

from adlattice.sources.tables import read_html_files, write_html_files


def layout(folder):
    return {f.parent.name: f.read_bytes() for f in folder.glob("page_id=*/part-*")}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"<p>å {i}</p>\r\n x") for i in range(300)] + [(-5, ""), (400, None), (None, "no id"), (401, "twice a"), (401, "twice a")]
    return spark.createDataFrame(rows, "page_id bigint, html string").repartition(5)


def test_files_equal_those_of_the_text_writer(spark, pages, tmp_path):
    write_html_files(pages, "page_id", f"file://{tmp_path}/own")
    pages.write.partitionBy("page_id").text(f"file://{tmp_path}/spark")
    together = {}
    for f in (tmp_path / "spark").glob("page_id=*/part-*"):
        together[f.parent.name] = together.get(f.parent.name, b"") + f.read_bytes()
    assert layout(tmp_path / "own") == together and len(together) == 304
    # Neither a checksum file, for which a process is started, nor an unfinished file is left.
    files = [f for f in tmp_path.glob("own*/*/*")]
    assert len(files) == 304 and all(f.name.startswith("part-") for f in files)
    back = read_html_files(spark, f"file://{tmp_path}/own").collect()
    assert sorted(r["html"] for r in back) == sorted(v.decode() for v in together.values())


def test_nothing_is_named_before_all_is_written(spark, pages, tmp_path):
    folder = f"file:{tmp_path}/out"
    with pytest.raises(Exception):
        write_html_files(pages.selectExpr("page_id", "CASE WHEN page_id = 7 THEN raise_error('no') ELSE html END AS html"), "page_id", folder)
    assert not (tmp_path / "out").exists()
    write_html_files(pages, "page_id", folder)
    with pytest.raises(FileExistsError):
        write_html_files(pages, "page_id", folder)


def test_other_keys_are_left_to_the_text_writer(spark, tmp_path):
    rows = spark.createDataFrame([("a/b", "x")], "page_id string, html string")
    write_html_files(rows, "page_id", f"file://{tmp_path}/out")
    assert layout(tmp_path / "out") == {"page_id=a%2Fb": b"x\n"}


def test_a_task_reads_many_small_files(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(40 * cores).selectExpr("id AS page_id", "'x' AS html")
    write_html_files(rows, "page_id", f"file://{tmp_path}/out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        back = read_html_files(spark, f"file://{tmp_path}/out")
        assert back.rdd.getNumPartitions() == 4 * cores and back.count() == 40 * cores
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
