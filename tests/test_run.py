"""The fetch job and whole runs, with an in-memory transport."""

import os
import sys
import time
import types

import pytest
from pyspark import cloudpickle
from compare import plan
from pyspark.sql import functions as F
from test_images import jpeg, png

from folio.operators import collect
from folio.operators.sift import sift
from folio.operators.spread import spread_join
from folio.plans import cli as command
from folio.plans.catalogue import genre_profile
from folio.plans.covers import fetch_attempts, read_log, run
from folio.session import shared_root, work_path
from folio.sinks import files as files_module
from folio.sinks.files import existing_ids_in_files, export_cover_files, finish_exports, qualified, read_manifest
from folio.sinks.store import bucket_of, covers_with_content, write_covers
from folio.sources import fetch as fetch_module
from folio.sources.covers import existing_ids, scan_cover_files
from folio.sources.fetch import Pace, fetch
from folio.sources.responses import image_attempts, image_bodies

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors lack the test folder

GOOD, WIDE = jpeg(200, 300), png(400, 300)


def site(url, headers, timeout):
    """Pages /p/<n> name image <n>; some pages or images fail."""
    assert headers["User-Agent"] and timeout == 10.0
    kind, n = url.rsplit("/", 2)[1:]
    n = int(n.removesuffix(".jpg"))
    if kind == "p":
        if n % 10 == 3:
            raise TimeoutError("no answer")
        if n % 10 == 4:
            return 503, b""
        return 200, f'<html><meta property="og:image" content="https://img/i/{n}.jpg"></html>'.encode()
    if n % 10 == 5:
        return 200, WIDE
    return 200, GOOD


def healed(url, headers, timeout):
    kind, n = url.rsplit("/", 2)[1:]
    if kind == "i":
        return 200, GOOD
    return 200, f'<meta property="og:image" content="https://img/i/{n}.jpg">'.encode()


def catalogue(spark, n=20):
    path = work_path(spark, "curated")
    spark.range(n).selectExpr("CAST(id AS STRING) AS id", "concat('https://site/p/', id) AS url").write.parquet(path)
    return path


def test_fetch_rows(spark):
    urls = spark.createDataFrame([("https://a/p/1",), ("https://a/p/3",), ("https://b/p/4",), (None,), ("https://a/p/1",)], "url string")
    rows = {row.url: row for row in fetch(urls, site, "page", 2, interval=0).collect()}
    assert set(rows) == {"https://a/p/1", "https://a/p/3", "https://b/p/4"}
    assert {(row.kind, row.attempt) for row in rows.values()} == {("page", 2)}
    assert rows["https://a/p/1"].status == 200 and b"og:image" in rows["https://a/p/1"].body
    assert rows["https://a/p/3"].status is None and "TimeoutError" in rows["https://a/p/3"].error
    assert rows["https://b/p/4"].status == 503


def test_bad_address_is_a_row(spark):
    def refuse(url, headers, timeout):
        raise ValueError("bad address")

    row = fetch(spark.createDataFrame([("no such thing",)], "url string"), refuse, "page", 1, interval=0).collect()[0]
    assert row.status is None and "bad address" in row.error


def test_transport_over_requests(monkeypatch):
    def get(url, headers, timeout):
        assert (url, headers, timeout) == ("https://a", {"User-Agent": "Mozilla/5.0"}, 10.0)
        return types.SimpleNamespace(status_code=404, content=b"gone", headers={"Content-Type": "text/html; Charset='x-y'"})

    monkeypatch.setitem(sys.modules, "requests", types.SimpleNamespace(get=get))
    assert fetch_module.requests_transport("https://a", fetch_module.HEADERS, fetch_module.TIMEOUT_S) == (404, b"gone", "x-y")


def stamp(url, headers, timeout):
    return 200, f"{time.time()} {os.getpid()}".encode()


def asked_at(rows):
    """Seconds of each request, by host."""
    hosts = {}
    for row in rows:
        hosts.setdefault(row.url.split("/")[2], []).append(float(row.body.split()[0]))
    return {host: sorted(times) for host, times in hosts.items()}


def test_charset_reaches_the_log(spark):
    def answer(url, headers, timeout):
        return 200, "été".encode("latin-1"), "latin-1"

    row = fetch(spark.createDataFrame([("https://a/1",)], "url string"), answer, "page", 1, interval=0).collect()[0]
    assert (row.charset, bytes(row.body)) == ("latin-1", b"\xe9t\xe9")


@pytest.mark.parametrize("tasks", [1, 2, 4])
def test_a_host_takes_an_interval_an_address_whatever_the_tasks(spark, tasks):
    urls = spark.createDataFrame([(f"https://one/p/{i}",) for i in range(48)] + [(f"https://two/p/{i}",) for i in range(5)], "url string")
    rows = fetch(urls, stamp, "page", 1, interval=0.1, tasks=tasks).collect()
    times = asked_at(rows)
    assert 47 * 0.1 * 0.8 <= times["one"][-1] - times["one"][0] <= 47 * 0.1 * 1.2
    assert min(b - a for a, b in zip(times["one"], times["one"][1:])) >= 0.05
    assert 4 * 0.1 * 0.8 <= times["two"][-1] - times["two"][0] <= 4 * 0.1 * 1.6
    assert len({row.body.split()[1] for row in rows}) == tasks


@pytest.mark.parametrize("lanes", [1, 4, 48, 100])
def test_pace_of_any_number_of_lanes(lanes):
    paces, asked = [Pace(1.0, 10.0) for _ in range(lanes)], []
    for place in range(48):
        pace = paces[place % lanes]
        asked.append(pace.due("one", place, min(lanes, 48)))
        pace.asked("one", asked[-1])
    assert asked == [10.0 + k for k in range(48)]


def test_a_late_lane_does_not_hurry():
    pace = Pace(1.0, 0.0)
    pace.asked("one", 30.0)  # its first address was due at 0
    assert [pace.due("one", 4, 4), pace.due("two", 4, 4)] == [34.0, 4.0]


def test_large_host_is_split(spark):
    urls = spark.range(400).selectExpr("concat('https://one/p/', id) AS url")
    rows = fetch(urls, stamp, "page", 1, interval=0).withColumn("part", F.spark_partition_id())
    parts = [row["count"] for row in rows.groupBy("part").count().collect()]
    assert parts == [100] * 4


def test_nothing_to_fetch(spark):
    assert fetch(spark.createDataFrame([], "url string"), stamp, "page", 1).collect() == []


def outcomes_of(result):
    return {row.id: row.outcome for row in result.outcomes.collect()}


def test_run_resumes(spark):
    curated, store, log = catalogue(spark), work_path(spark, "store"), work_path(spark, "log")
    first = run(spark, curated, store, log, site, "one", sample_size=20, interval=0, buckets=4, slices=2)
    bad = {str(n) for n in range(20) if n % 10 in (3, 4, 5)}
    assert outcomes_of(first) == {str(n): "failed" if str(n) in bad else "success" for n in range(20)}
    assert {row.reason for row in first.outcomes.collect()} == {None, "no_page", "bad_status", "too_wide"}
    assert tuple(first.counters.first()) == (14, 6)
    assert len(first.progress.collect()) == 1
    # Settled addresses are asked once, the others three times.
    asked = {row.url: row["count"] for row in read_log(spark, f"{log}/run=one").where("kind = 'page'").groupBy("url").count().collect()}
    assert asked == {f"https://site/p/{n}": 3 if str(n) in bad else 1 for n in range(20)}

    again = run(spark, curated, store, log, site, "two", sample_size=20, interval=0, buckets=4)
    assert outcomes_of(again) == {str(n): "failed" if str(n) in bad else "skipped" for n in range(20)}
    assert existing_ids(spark, store).count() == 14

    last = run(spark, curated, store, log, healed, "three", sample_size=20, interval=0, buckets=4)
    assert outcomes_of(last) == {str(n): "success" if str(n) in bad else "skipped" for n in range(20)}
    stored = spark.read.parquet(store)
    assert stored.count() == stored.select("id").distinct().count() == 20
    assert {(row.width, row.height, bytes(row.content)) for row in stored.collect()} == {(200, 300, GOOD)}


def test_run_resumes_over_loose_files(spark):
    curated, images = catalogue(spark), work_path(spark, "images")
    bad = {str(n) for n in range(20) if n % 10 in (3, 4, 5)}
    run(spark, curated, work_path(spark, "store"), work_path(spark, "log"), site, "one", sample_size=20, interval=0, images=images)
    assert pictures(images) == sorted(f"{n}.jpg" for n in range(20) if str(n) not in bad)
    store = work_path(spark, "store")  # another store: only the files tell what is done
    again = run(spark, curated, store, work_path(spark, "log"), healed, "two", sample_size=20, interval=0, images=images)
    assert outcomes_of(again) == {str(n): "success" if str(n) in bad else "skipped" for n in range(20)}
    assert pictures(images) == sorted(f"{n}.jpg" for n in range(20))


def test_broken_off_run_goes_on(spark):
    curated, log = catalogue(spark, 6), work_path(spark, "log")
    todo = spark.read.parquet(curated)
    fetch_attempts(todo, log, site, interval=0)
    before = read_log(spark, log).count()

    def never(url, headers, timeout):
        raise AssertionError("asked again")

    fetch_attempts(todo, log, never, interval=0)
    rows = read_log(spark, log)
    assert rows.count() == before and rows.where("error LIKE '%asked again%'").count() == 0


def test_whole_catalogue_without_sample(spark):
    result = run(spark, catalogue(spark, 7), work_path(spark, "store"), work_path(spark, "log"), healed, "x", sample_size=None, interval=0)
    assert sorted(row.ord for row in result.outcomes.collect()) == list(range(7))
    assert tuple(result.counters.first()) == (7, 0)


def test_strict_sample(spark):
    with pytest.raises(ValueError, match="without replacement"):
        run(spark, catalogue(spark, 3), "s", "l", site, "x", sample_size=4)


def logged(spark, rows, files=3):
    """Image responses ``img_url, attempt, content`` as a log in files, as the job leaves it."""
    path = work_path(spark, "log")
    rows.selectExpr("img_url AS url", "'image' AS kind", "attempt", "200 AS status", "content AS body").repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def described(won, log, length=None):
    covers = collect.covers_described(won, image_attempts(log))
    return covers if length is None else covers.withColumn("length", F.lit(length).cast("bigint"))


@pytest.fixture
def shared_picture(spark, monkeypatch):
    """One picture serves two thirds of the ids, recorded many times; joins take the spread path."""
    from folio.sinks import store as store_module

    monkeypatch.setattr(store_module, "spread_join", lambda *a, **k: spread_join(*a, **k, small_rows=0, lanes=16))
    won = spark.range(90).selectExpr(
        "CAST(id AS STRING) AS id", "CASE WHEN id % 3 = 0 THEN concat('i', id) ELSE 'shared' END AS img_url", "1 AS attempt"
    )
    once = won.select("img_url", "attempt").distinct().withColumn("content", F.lit(GOOD))
    repeated = once.where("img_url = 'shared'").crossJoin(spark.range(50)).drop("id")
    return won, logged(spark, once.union(repeated))


def check_store(spark, path):
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("id").distinct().count() == 90
    assert stored.where(bucket_of(F.col("id"), 2) != F.col("bucket")).count() == 0
    assert {bytes(row.content) for row in stored.select("content").distinct().collect()} == {GOOD}
    return len(stored.inputFiles())


@pytest.mark.parametrize(("length", "files"), [(None, 2), (50_000_000, 7)])
def test_store(spark, shared_picture, length, files):
    won, log = shared_picture
    path = work_path(spark, "store")
    write_covers(described(won, log, length), image_bodies(log), path, buckets=2)
    assert check_store(spark, path) >= files  # 4.5 gigabytes are five tasks of two files, if each has ids of both buckets


def test_bodies_that_are_not_stored_stay_where_they_are(spark):
    pictures_ = spark.range(300).selectExpr("concat('i', id) AS img_url", "1 AS attempt")
    log = logged(spark, pictures_.crossJoin(spark.range(40)).select("img_url", "attempt", F.lit(GOOD).alias("content")))
    won = pictures_.withColumn("id", F.col("img_url"))
    covers, bodies = described(won, log), image_bodies(log)
    assert bodies.count() == 12_000
    assert sift(bodies, covers, ["file", "row"]).count() < 320  # what the one shuffle of bytes moves
    assert covers_with_content(covers, bodies).count() == 300
    shape = lambda n: [line for line in plan(covers_with_content(covers.limit(n), bodies, tasks=2)).splitlines() if line.startswith("(")]
    assert len(shape(1)) == len(shape(300))


def test_only_the_checked_bytes_are_stored(spark):
    won = spark.createDataFrame([("1", "a", 1)], "id string, img_url string, attempt int")
    log = logged(spark, spark.createDataFrame([("a", 1, WIDE), ("a", 1, GOOD), ("a", 2, GOOD), ("b", 1, GOOD)], "img_url string, attempt int, content binary"))
    rows = covers_with_content(described(won, log), image_bodies(log)).collect()
    assert [(row.id, bytes(row.content)) for row in rows] == [("1", GOOD)]


def pictures(folder):
    return sorted(name for name in os.listdir(folder) if name.endswith(".jpg"))


def test_loose_files(spark):
    folder = work_path(spark, "files")
    covers = spark.createDataFrame([("1", GOOD), ("2", WIDE), ("3", None)], "id string, content binary")
    assert export_cover_files(covers, folder) == 2
    assert export_cover_files(covers, f"file://{folder}") == 2  # again: same files
    assert pictures(folder) == ["1.jpg", "2.jpg"] and os.listdir(f"{folder}/_exports") == []
    assert {row.id: bytes(row.content) for row in scan_cover_files(spark, folder).collect()} == {"1": GOOD, "2": WIDE}
    assert sorted(row.id for row in existing_ids_in_files(spark, folder).collect()) == ["1", "2"]


@pytest.mark.parametrize("name", ["../x", None, "..", ""])
def test_a_failed_export_leaves_no_file(spark, name):
    folder = work_path(spark, "files")
    rows = [(str(i), GOOD) for i in range(40)] + [(name, GOOD)]
    with pytest.raises(Exception, match="cannot name a file"):
        export_cover_files(spark.createDataFrame(rows, "id string, content binary").repartition(4), folder)
    assert pictures(folder) == [] and finish_exports(spark, folder) == 0
    assert existing_ids_in_files(spark, folder).count() == 0


def test_a_committed_export_is_carried_to_its_end(spark, monkeypatch):
    folder = work_path(spark, "files")
    covers = spark.createDataFrame([(str(i), GOOD) for i in range(9)], "id string, content binary").repartition(3)
    real = files_module.finish_exports
    monkeypatch.setattr(files_module, "finish_exports", lambda *a: 0)  # the driver is lost after the commit
    export_cover_files(covers, folder)
    monkeypatch.setattr(files_module, "finish_exports", real)
    assert pictures(folder) == []
    aside = f"{folder}/_exports/{os.listdir(folder + '/_exports')[0]}"
    task = next(name for name in os.listdir(aside) if os.path.isdir(f"{aside}/{name}"))
    moved = next(name for name in os.listdir(f"{aside}/{task}") if name.endswith(".jpg"))
    os.rename(f"{aside}/{task}/{moved}", f"{folder}/{moved}")  # as if an executor had been lost while moving
    assert finish_exports(spark, folder) == 9
    assert pictures(folder) == sorted(f"{i}.jpg" for i in range(9))
    assert sorted(row.id for row in read_manifest(spark, folder).collect()) == [str(i) for i in range(9)]


def test_files_from_before_the_manifest_count(spark):
    folder = work_path(spark, "files")
    os.makedirs(folder)
    open(f"{folder}/old.jpg", "wb").write(GOOD)
    assert [row.id for row in existing_ids_in_files(spark, folder).collect()] == ["old"]
    export_cover_files(spark.createDataFrame([("new", GOOD)], "id string, content binary"), folder)
    assert sorted(row.id for row in existing_ids_in_files(spark, folder).collect()) == ["new", "old"]
    assert "binaryFile" not in plan(existing_ids_in_files(spark, folder))  # the folder is not listed again


def test_paths_get_their_scheme(spark):
    assert qualified(spark, "/a/b/") == "file:/a/b"
    assert files_module._open("file:/a/b")[1] == "/a/b"


def test_shared_folder_is_the_named_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_store_yet(spark):
    assert existing_ids(spark, work_path(spark, "none")).count() == 0


def test_profile(spark):
    books = spark.createDataFrame([("['a', 'b']",), ("['a']",)], "genres string")
    profile = genre_profile(books, top=1, min_count=0)
    assert [tuple(row) for row in profile.top.collect()] == [("a", 2)]
    assert profile.distinct.first()[0] == profile.frequent.count() == 2


def test_command_line(spark, capsys):
    source, curated = work_path(spark, "source"), work_path(spark, "curated")
    rows = [(str(i), f"https://site/p/{i}", "['a', 'b']" if i % 2 else "['a']", 7000 + i * 100, 1) for i in range(12)]
    spark.createDataFrame(rows, "id string, url string, genres string, num_ratings bigint, num_reviews bigint").write.json(source)
    command.run_command(spark, command.parse(["curate", source, curated, "--format", "json"]))
    assert spark.read.parquet(curated).count() == 6
    command.run_command(spark, command.parse(["genres", curated, "--min-count", "3"]))
    out = capsys.readouterr().out
    assert "|a    |6    |" in out and "|b    |3    |" in out


def test_work_is_dropped(spark, monkeypatch):
    from folio import session

    monkeypatch.setattr(session, "_work_root", lambda s: f"{shared_root(s)}/other")
    path = work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.drop_work(spark)
    assert not os.path.exists(f"{shared_root(spark)}/other")


def test_commands():
    args = command.parse(["collect", "c", "s", "l", "--run-id", "r"])
    assert (args.sample, args.seed, args.slices, args.images) == (2000, 42, None, None)
    assert command.parse(["curate", "a", "b"]).min_ratings == 7500
    assert command.parse(["genres", "a"]).top == 29
