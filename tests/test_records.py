"""Raw catalogue files: records, their types, and what is set aside."""

import csv
import io
import json
import random

import pytest
from compare import plan

from folio.plans.catalogue import curate_to
from folio.session import work_path
from folio.sources.catalog import load_books, read_books
from folio.sources.records import read_csv

HEAD = ["id", "url", "genres", "num_ratings", "num_reviews", "note"]


def books(rng, n):
    text = lambda: "".join(rng.choice(["a", "b", '"', ",", "\n", " ", "é", "\n\n"]) for _ in range(rng.randint(0, 12)))
    return [[str(k), f"u{k}", "['x']", str(8000 + k), "3", "n" + text() + "."] for k in range(n)]


def written(folder, name, rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([HEAD, *rows])
    (folder / name).write_text(out.getvalue())


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_csv_records_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(4)
    rows = {name: books(rng, 60) for name in ("a.csv", "b.csv", "c.csv")}
    for name, part in rows.items():
        written(tmp_path, name, part)
    found = read_csv(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    # Blank lines inside a quoted text are kept, as everything in it.
    assert sorted(tuple(r) for r in found.rows.collect()) == sorted(tuple(r) for part in rows.values() for r in part)
    assert found.bad.count() == 0 and found.seen.get == {"n_records": 180, "n_bad": 0}


def test_csv_without_breaks_is_read_by_lines(spark, tmp_path, small_splits):
    written(tmp_path, "a.csv", [[str(k), "u", "[]", "5", "1", 'a "q", b'] for k in range(50)])
    found = read_csv(spark, str(tmp_path))
    assert "Exchange" not in plan(found.rows)
    assert found.rows.count() == 50 and {r.note for r in found.rows.collect()} == {'a "q", b'}


def test_csv_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(HEAD) + '\n1,u,[],5,1,x\n2,two\n\n3,u,[],5,1,x,y\n4,u,[],5,1,"open\n5,u,[],6,1,z\n')
    found = read_csv(spark, str(tmp_path))
    assert sorted(r.id for r in found.rows.collect())[0] == "1" and "5" in {r.id for r in found.rows.collect()}
    assert {r.record for r in found.bad.collect()} >= {"2,two", "3,u,[],5,1,x,y"}


def test_json_records(spark, tmp_path):
    lines = [
        json.dumps({"id": 7, "url": "u", "genres": ["a", "b"], "num_ratings": "9000", "num_reviews": 3, "note": "x", "odd name": 1.5, "deep": {"y": [1]}}),
        json.dumps({"id": "q", "url": None, "genres": "['z']", "num_ratings": 8000.0, "note": None}),
        "", "no json", "[1, 2]", '{"id": "cut',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    frame, records = read_books(spark, str(tmp_path), "json")
    rows = {r.id: r for r in frame.collect()}
    assert set(rows) == {"7", "q"}
    assert (rows["7"].genres, rows["7"].num_ratings, rows["7"].note, rows["7"]["odd name"]) == ('["a","b"]', 9000.0, "x", 1.5)
    assert (rows["q"].genres, rows["q"].num_reviews, rows["q"].deep) == ("['z']", None, None)
    assert dict(frame.dtypes)["deep"] == "variant" and json.loads(str(rows["7"].deep)) == {"y": [1]}
    assert sorted(r.record for r in records.bad.collect()) == ["[1, 2]", "no json", '{"id": "cut']
    stated = load_books(spark, str(tmp_path), "json", schema={"note": "string"})
    assert stated.columns == ["id", "url", "genres", "num_ratings", "num_reviews", "note", "other"]
    assert plan(stated).count("Scan text") <= 2  # once in the tree and once in its list: one pass


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_quarantine(spark, tmp_path, fmt):
    source, target, aside = tmp_path / "in", work_path(spark, "cur"), work_path(spark, "aside")
    source.mkdir()
    if fmt == "json":
        book = {"id": "1", "url": "u", "genres": "['a']", "num_ratings": 9000, "num_reviews": 1}
        (source / "a.json").write_text(json.dumps(book) + "\nbroken\n")
    else:
        (source / "a.csv").write_text(",".join(HEAD) + "\n1,u,['a'],9000,1,x\nbroken\n")
    done = curate_to(spark, str(source), target, fmt, quarantine=aside)
    assert (done.books.count(), done.n_bad, done.funnel["n_books"]) == (1, 1, 1)
    assert [r.record for r in spark.read.parquet(aside).collect()] == ["broken"]
