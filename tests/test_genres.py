import ast
import json
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import plan
from folio.functions.genres import is_plain_list, parse_genres
from folio.operators import genres
from folio.plans.catalogue import genre_profile

EDGES = {
    "[]": [],
    "[ ]": [],
    """['Fiction', "Children's"]""": ["Fiction", "Children's"],
    '["A","B"]': ["A", "B"],
    "['a', None]": ["a", None],
    "['a',]": ["a"],
    "('a','b')": ["a", "b"],
    '["A","A"]': ["A", "A"],
    "['it\\'s']": ["it's"],
    "['a' 'b']": ["ab"],
    "['a, b', 'c]d']": ["a, b", "c]d"],
    "not a list": None,
    "('a')": None,
    "[1, 2]": ["1", "2"],
    "['a'": None,
    "[['a']]": None,
    "": None,
    '["\\ud83d\\ude00"]': ["\U0001f600"],
}


def frame(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "genres string")


def test_edges(spark):
    rows = frame(spark, EDGES).select("genres", parse_genres(F.col("genres")).alias("items")).collect()
    assert {row.genres: row["items"] for row in rows} == EDGES


words = st.text(alphabet=st.characters(blacklist_categories=["Cs"]), max_size=6)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(words, max_size=4), min_size=1, max_size=40))
def test_written_lists_read_back(spark, lists):
    texts = [repr(items) for items in lists] + [json.dumps(items) for items in lists]
    got = [row["items"] for row in frame(spark, texts).select(parse_genres(F.col("genres")).alias("items")).collect()]
    assert got == lists + lists


pieces = st.lists(st.sampled_from(["[", "]", "'", '"', ",", " ", "a", "b'c", "None", "\\", "\n", "\t", "(", ")"]), max_size=9)


@settings(max_examples=15, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=200))
def test_pattern_never_disagrees_with_the_literal(spark, rows):
    texts = ["[" + "".join(row) + "]" for row in rows]
    df = frame(spark, texts).select("genres", is_plain_list(F.col("genres")).alias("plain"), parse_genres(F.col("genres")).alias("items"))
    for row in df.collect():
        if row.plain:
            assert row["items"] == ast.literal_eval(row.genres)


def test_counts_match_a_counter(spark):
    texts = [text for text, items in EDGES.items() for _ in range(3)]
    want = Counter(item for text in texts for item in EDGES[text] or [])
    got = {row.genre: row["count"] for row in genres.genre_counts(frame(spark, texts)).collect()}
    assert got == want
    assert genres.genre_distinct(genres.genre_counts(frame(spark, texts))).first()[0] == len(want)


def test_counts_of_arrays(spark):
    df = spark.createDataFrame([(["a", "a", None],), ([],), (None,), (["b"],)], "genres array<string>")
    assert {row.genre: row["count"] for row in genres.genre_counts(df).collect()} == {"a": 2, None: 1, "b": 1}


def test_malformed_text_fails_on_request(spark):
    with pytest.raises(Exception, match="not a genre list"):
        genres.genre_counts(frame(spark, ["['a']", "not a list"]), fail=True).collect()
    with pytest.raises(Exception, match="not a genre list"):
        genres.genre_explode(frame(spark, ["not a list"]), fail=True).collect()


def test_parse_report(spark):
    assert tuple(genres.genre_parse_report(frame(spark, [*EDGES, None])).first()) == (7, 6, 5)


def test_ranking_threshold_and_top(spark):
    counts = spark.createDataFrame([("b", 3), ("a", 3), ("c", 9), ("d", 1)], "genre string, count bigint")
    assert [row.genre for row in genres.genre_top(counts, 3).collect()] == ["c", "a", "b"]
    assert [row.genre for row in genres.genre_ranked(counts).collect()] == ["c", "a", "b", "d"]
    assert genres.genre_frequent_count(counts, 3).first()[0] == 1  # strictly above


def test_odd_lists_are_read_once(spark):
    books = frame(spark, ["['a', None]", "('b',)", "['c']", "[]", "junk", None]).withColumn("id", F.monotonically_increasing_id())
    rows = genres.genre_explode(books, "id")
    assert plan(rows).count("ArrowEvalPython") == plan(genres.with_genre_list(books)).count("ArrowEvalPython") > 0
    assert sorted((row.genre or "") for row in rows.collect()) == ["", "a", "b", "c"]


def test_malformed_texts_are_counted(spark):
    profile = genre_profile(frame(spark, ["['a']", "['a', 'it\\'s']", "oops", "[1", None]), min_count=0)
    assert tuple(profile.parsed.first()) == (1, 1, 2)
    assert {tuple(row) for row in profile.counts.collect()} == {("a", 2), ("it's", 1)}
    with pytest.raises(Exception, match="not a genre list"):
        genre_profile(frame(spark, ["['a']", "oops"]), fail=True)


def test_sketches_are_close_and_merge(spark):
    books = spark.range(40_000).selectExpr("id % 8 AS part", "array('g' || id % 20000, 'h' || id, 'same', null) AS genres")
    sketches = genres.genre_sketches(books, "part")
    assert sketches.count() == 8
    per = {row.part: row.n_genres for row in genres.genre_distinct_approx(sketches, "part").collect()}
    for part in range(8):
        assert abs(per[part] - 7501) < 5 * 0.013 * 7501  # 2,500 shared, 5,000 of its own, and one
    assert abs(genres.genre_distinct_approx(sketches).first()[0] - 60_001) < 5 * 0.013 * 60_001
    assert genres.genre_distinct_approx(sketches.limit(0)).first()[0] == 0
    assert max(len(row.sketch) for row in sketches.collect()) < 5000
