"""The manifest against a plain tree, on nulls, repeated rows, lone groups and extra columns."""

import hashlib
import random
import zlib

import pytest
from compare import duck, duck_rows, plan, spark_rows

from folio.llm import merkle
from folio.llm.oracle import ORACLE
from folio.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, at long, level int, leaf string, place int, n long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def climb(tree, at, value):
    """The siblings on the way up and what ``value`` in this place comes to."""
    met = []
    for level in tree[:-1]:
        begin = at // 16 * 16
        run = level[begin : begin + 16]
        met += run[: at - begin] + run[at - begin + 1 :]
        run[at - begin] = value
        value, at = sha(*run), at // 16
    return met, value


def plain(rows):
    groups = {}
    for r in rows:
        changed = list(r)
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            changed[4] = lowered(r[4])
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(changed)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[s])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for at, (known, i, own, changed) in enumerate(sorted(groups[s])):
            met, value = climb(trees[k], at, changed)
            above, value = climb(top, k, value)
            root = top[-1][0]
            out.append((i if known else None, own, trees[k][-1][0], root, sha(*met, *above), value, value == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, 7, "x", 7, 7) for r in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, "hot", "en", i, f"Text {i} " + "Ab" * rng.randint(0, 9)) for i in rng.sample(range(10_000), 300)]
    out += [(i, f"s{i % 20}", None, None, rng.choice(["", None, "Ä Z", "zz"])) for i in range(20_000, 20_060)]
    out += [(None, None, "en", 1, "A"), (None, None, "en", 1, "B"), (5, None, None, None, None), (30_000, "lone", "en", 2, "Q")]
    return out + [(30_001, "twice", "en", 3, "Same")] * 3 + [(30_002, "ünder", "en", 3, "X" * 2_000_000)]


def test_every_row_has_its_proof(spark, rows):
    want = plain(rows)
    assert found(merkle.merkle_report(frame(spark, rows))) == want
    assert {r[-1] for r in want} == {True, False}


def test_light_nodes_are_met_by_shuffles(spark, rows):
    docs = frame(spark, rows).select("doc_id", "source", "lang", "n_chars", "text")
    manifest = merkle.build(docs, tampered=merkle.lowered_text(docs))
    assert found(merkle.proofs(manifest, heavy_nodes=3)) == plain(rows)
    assert manifest.nodes.filter("up_tree IS NULL").count() == 1
    up = {(r.tree, r.level, r.at) for r in manifest.nodes.collect()}
    assert {(r.up_tree, r.up_level, r.up_at) for r in manifest.nodes.filter("up_tree IS NOT NULL").collect()} <= up
    assert "Recurs" in plan(merkle.proofs(manifest)) or "UnionLoop" in plan(merkle.proofs(manifest))


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_sizes_around_a_run(spark, n):
    rows = [(i, "s", "en", i, f"T{i}") for i in range(n)]
    assert found(merkle.merkle_report(frame(spark, rows))) == plain(rows)


def test_groups_of_one_row(spark):
    rows = [(i, f"g{i}", "en", i, f"T{i}") for i in range(40)]
    assert found(merkle.merkle_report(frame(spark, rows))) == plain(rows)


def test_manifest_sql(spark, sf_dir):
    name = "op11_merkle_manifest"
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE[name])
