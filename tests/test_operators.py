"""Operators against plain Python, and every demo query against its SQL on the smallest tables."""

import itertools
import os
import random
import re
import unicodedata
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import assignment, sequences, trees
from quire.plans import catalogue, contents, demos  # noqa: F401
from quire.sources import catalogue as sources
from quire.streaming import worker

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)].copy()
    show = lambda x: "" if pd.isna(x) else repr(round(float(x), 6)) if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.dtype.kind in "if" else str(x)
    return sorted(tuple(map(show, r)) for r in df.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(catalogue.ORACLES[name]).df())


def test_resolve_is_optimal():
    rng = random.Random(1)
    for _ in range(300):
        entries = [sorted(((rng.randint(0, 4), rng.choice([None, rng.randint(0, 3)]), (1, rng.randint(0, 3))) for _ in range(rng.randint(0, 3))), key=lambda c: (c[0], c[1] is None, c[1] or 0)) for _ in range(rng.randint(0, 4))]
        best = None
        for pick in itertools.product(*[[None, *range(len(e))] for e in entries]):
            chosen = [e[k] for e, k in zip(entries, pick, strict=True) if k is not None]
            heads = [c[1] for c in chosen if c[1] is not None]
            if any(a[0] > b[0] for a, b in itertools.pairwise(chosen)) or any(a >= b for a, b in itertools.pairwise(heads)):
                continue
            value = (tuple(sum(c[2][i] for c in chosen) for i in range(2)), tuple(-len(e) if k is None else -k for e, k in zip(entries, pick, strict=True)))
            best = max(best, (value, pick)) if best else (value, pick)
        got = assignment.resolve(entries)
        value = (tuple(sum(e[k][2][i] for e, k in zip(entries, got, strict=True) if k is not None) for i in range(2)), tuple(-len(e) if k is None else -k for e, k in zip(entries, got, strict=True)))
        width = any(entries)
        assert value == best[0] or not width


def test_best_chain_is_longest():
    rng = random.Random(2)
    for _ in range(200):
        o = [(rng.randint(0, 4), rng.randint(0, 4), (rng.randint(0, 3),)) for _ in range(rng.randint(0, 6))]
        ok = lambda c: all(a[0] < b[0] and a[1] <= b[1] for a, b in itertools.pairwise(c))
        best = max((len(c), sum(x[2][0] for x in c)) for n in range(len(o) + 1) for c in itertools.permutations(o, n) if ok(c))
        got = [o[i] for i in assignment.best_chain(o)]
        assert ok(got) and (len(got), sum(x[2][0] for x in got)) == best


def test_consolidate():
    rows_ = [(1, "1", 0.9, "1900", 0.9), (2, "1", 0.5, None, None), (3, "2", 0.5, "1900", 0.99), (4, None, None, None, None), (5, "7", 0.4, None, None), (6, "7", 0.6, None, None)]
    assert assignment.consolidate(rows_) == [(1, [1, 2, 3]), (6, [5, 6])]


def test_monotonicity_and_clusters(spark):
    v = lambda *x: F.array(*map(F.lit, x))
    r = spark.range(1).select(sequences.monotonicity(v(1, 2, 3, 4, 5, 7, 6, 8, 9, 10)).alias("m"), sequences.leader_clusters(v(1.0, 1.5, 2.0, 9.0, 9.1, 30.0), 1.0, 2).alias("c")).first()
    assert r.m == 9 and [(c.low, c.n) for c in r.c] == [(1.0, 3), (9.0, 2)]


def test_cycle_ends_the_walk(spark):
    t = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "zz")], "id string, parent string")
    assert sorted(map(tuple, trees.ancestors(t).select("node", "ancestor").collect())) == [("a", "b"), ("b", "a")]


def test_sources(spark):
    x = spark.createDataFrame([(1, "<a"), (2, '<alto xmlns="http://www.loc.gov/standards/alto/ns-v3#"/>'), (3, "<PcGts/>"), (4, "<x/>")], "i int, x string")
    assert [r.f for r in x.select("i", sources.xml_format(F.col("x")).alias("f")).orderBy("i").collect()] == ["INVALID_XML", "ALTO", "PAGE", "UNKNOWN"]
    y = spark.createDataFrame([(1, "[1901]-1903?"), (2, "1850"), (3, "s.a."), (4, None)], "i int, x string")
    assert [tuple(r.y) if r.y else None for r in y.select("i", sources.year_range(F.col("x")).alias("y")).orderBy("i").collect()] == [(1901, 1903), (1850, 1850), None, None]
    ok, bad = "uuid:01234567-89ab-cdef-0123-456789abcdef", "uuid:nope"
    p = spark.createDataFrame([(1, f'{{"type":"x","objects":[{{"id":"{ok}","mods":"m"}}]}}'), (2, f'{{"type":"x","objects":[{{"id":"{ok}"}},{{"id":"{bad}"}}]}}'), (3, "broken")], "k int, j string")
    assert [r.k for r in sources.package_objects(spark, p, "j", "k").collect()] == [1]


def test_worker_isolates_failures(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("a", '{"batch":"b"}'), ("b", '{"batch":"b","odd":"x"}'), ("c", '{"objects":"o"}'), ("d", "no json")], "id string, value string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs = spark.readStream.schema("id string, value string").parquet(str(tmp_path / "in"))
    worker.run_jobs(jobs, lambda df: df.select("id", "batch", "package"), str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp"), None).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "ok")).collect()) == ["a", "c"]
    assert sorted((r.id, r.error) for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [("b", "unknown keys"), ("d", "unreadable")]


def test_text_normalise_takes_the_whole_text(spark, tmp_path):
    """Texts beyond those of the tables, held against Python."""
    texts = ["Ab É 9 " * 40 + "  Zadní ČÁST 2024!", "x" * 200 + "Ž end", "short", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.norm for r in catalogue.QUERIES["text_normalise"](spark, str(tmp_path)).collect()}
    plain = lambda t: re.sub(r"\W+", " ", "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not unicodedata.combining(c))).strip()
    assert got == {i: None if t is None else plain(t) for i, t in enumerate(texts)}


def test_iou_join_and_cardinality_take_every_line(spark, tmp_path):
    """Lines of every number, held against Python."""
    rng = random.Random(4)
    lines = [(o, n, rng.randint(1, 6), 1, float(rng.randint(1, 50)), rng.choice("ARN"), rng.randint(0, 10) / 100) for o in range(1, 41) for n in range(1, rng.randint(2, 8))]
    orders = [(o, rng.randint(1, 8)) for o in range(1, 41)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))

    def iou(a, b):
        over = lambda p, q, v, w: max(min(p + v, q + w) - max(p, q), 0)
        i = over(a[1] * 10.0, b[1] * 10.0, a[4], b[4]) * over(a[6] * 100, b[6] * 100, 10.0, 10.0)
        return i / (a[4] * 10 + b[4] * 10 - i)

    want = [(a[0], a[2], b[2], round(iou(a, b), 6)) for a in lines for b in lines if a[0] == b[0] and a[5] == "A" and b[5] == "R" and iou(a, b) > 0.2]
    got = [tuple(r) for r in catalogue.QUERIES["iou_join"](spark, str(tmp_path)).collect()]
    assert sorted(x[:3] for x in got) == sorted(x[:3] for x in want) and any(o % 10 for o, *_ in got)
    assert [x[3] for x in sorted(got)] == pytest.approx([x[3] for x in sorted(want)], abs=2e-6)

    left, right = Counter(c for _, c in orders), Counter(x[2] for x in lines)
    branch = lambda n, m: "n:m" if n > 1 and m > 1 else "n:1" if n > 1 else "1:n" if m > 1 else "1:1"
    got = [tuple(r) for r in catalogue.QUERIES["number_join_cardinality"](spark, str(tmp_path)).select("k", "n_left", "n_right", "branch").collect()]
    assert sorted(got) == sorted((k, n, right[k], branch(n, right[k])) for k, n in left.items() if k in right)
