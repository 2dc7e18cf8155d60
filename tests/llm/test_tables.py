"""Operators on whole tables against brute force: packing, mixing, similarity join, neighbours, and the pipeline."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import jaccard, mixing, neighbours, packing
from quire.llm.queries import tokenizer_path
from tests.llm.test_texts import ODD, odd

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("ta", "se", "vo", "xi", "zu", "den", "for")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact and near copies, short ones, and shared passages."""
    rng = random.Random(5)
    out, passage = [], prose(rng, 60)
    for _ in range(60):
        t = prose(rng, rng.randint(1, 150))
        out.append(t)
        for _ in range(rng.choice([0, 0, 1, 4])):
            ws = t.split()
            for _ in range(rng.randint(0, 3)):
                ws[rng.randrange(len(ws))] = rng.choice(WORDS)
            out.append(" ".join(ws).upper() if rng.random() < 0.3 else "\n".join(ws))
    return out + [passage + " " + prose(rng, 30) for _ in range(5)] + ["", None, " \t", "one two", "ONE  two", "one two three"]


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} if ws else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (2, 60)])
def test_join_equals_brute_force(spark, corpus, k, percent):
    df = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string").repartition(5)
    got = jaccard.join(df, k, percent, chunk=4).orderBy("doc_id").collect()
    sizes, comp = brute_components(corpus, k, percent)
    assert [r.n_shingles for r in got] == sizes and [r.component_id for r in got] == comp
    assert len(set(comp)) < len(comp) - 20


def test_every_link_shares_a_tile():
    """The tiles of two sets with as few common members as a link may have."""
    rng = np.random.default_rng(0)
    table = jaccard.levels(80, 5000)
    firsts = np.asarray([f for f, _, _ in table])
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = a.copy()
        while True:
            c = np.unique(np.concatenate([np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else b, rng.integers(0, 1 << 63, 1).astype(np.uint64) if rng.random() < 0.5 else b[:0]]))
            both = len(np.intersect1d(a, c))
            if 100 * both < 80 * (len(a) + len(c) - both):
                break
            b = c
        assert np.intersect1d(jaccard.tiles(a, 80, table, firsts), jaccard.tiles(b, 80, table, firsts)).size


def test_rare_tiles_keep_every_link_and_few_other_pairs(spark):
    """Documents around one passage share tiles without being linked: those tiles are spared, and no link is lost."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    texts = [[*passage, *(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(110, 220)))] for _ in range(120)]
    texts += [[*t[:-n], *(f"v{rng.randrange(10**6)}" for _ in range(n))] for n, t in enumerate(texts[:12], 1)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    sets = jaccard.shingle_sets([" ".join(t) for t in texts], 5)
    by_node = {jaccard.node_of(u): u for u in sets}
    met = jaccard.laid(df, 5, 80, "doc_id", "text")

    def pairs(rows):
        by = defaultdict(set)
        for r in rows:
            by[r.tile].add(r.node)
        return {(a, b) for s in by.values() for a in s for b in s if a < b}

    def linked(a, b):
        both = len(np.intersect1d(by_node[a], by_node[b]))
        return 100 * both >= 80 * (len(by_node[a]) + len(by_node[b]) - both)

    every, some = pairs(met.where("tile is not null").collect()), pairs(jaccard.rarest(met).collect())
    links = {(a, b) for a in by_node for b in by_node if a < b and linked(a, b)}
    assert len(links) == 12 and links <= some <= every and len(some - links) * 10 < len(every - links)


def test_spared_tiles_lose_no_link_in_any_order():
    """Pairs with as few common members as a link may have, tiles in a random order."""
    rng = np.random.default_rng(3)
    for percent in (60, 80, 85):
        table = jaccard.levels(percent, 5000)
        firsts = np.asarray([f for f, _, _ in table])
        for _ in range(150):
            n = int(rng.integers(1, 500))
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone = int(rng.integers(0, len(a) * (100 - percent) // 100 + 1))
            both = rng.permutation(a)[gone:]
            own = rng.integers(0, 1 << 63, max(0, 100 * len(both) // percent - len(a))).astype(np.uint64)
            b, salt = np.unique(np.concatenate([both, own])), np.uint64(rng.integers(1 << 62))
            left = []
            for u in (a, b):
                t, spares = jaccard.tiles_and_spares(u, percent, table, firsts)
                t = t[np.argsort(jaccard.mixed(t ^ salt))]
                left.append(np.concatenate([t[(t & np.uint64(jaccard.LEVEL)) == lev][spare:] for lev, spare in enumerate(spares[1:], spares[0])]))
            assert not len(both) or np.intersect1d(*left).size


def test_points_are_packed_whole():
    rng = np.random.default_rng(2)
    points = [rng.poisson(m, jaccard.GROUPS).astype(np.int32) for m in (0, 1, 3, 30, 300, 70_000)]
    assert (jaccard.unpacked([jaccard.packed(p) for p in points]) == np.stack(points)).all()


def test_sets_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", " \n", "a", "x" * 500, " " * 300, "x" * 90 + " y " + "z" * 200 + " q r s t", *[" ".join(rng.choice("abcdefg") * rng.randrange(1, 9) for _ in range(rng.randrange(60))) for _ in range(50)]]
    whole = [jaccard.shingle_sets(texts, k) for k in (1, 4)]
    for size in (16, 100, 333):
        monkeypatch.setattr(jaccard, "SLICE", size)
        for k, want in zip((1, 4), whole, strict=True):
            assert all(np.array_equal(a, b) for a, b in zip(jaccard.shingle_sets(texts, k), want, strict=True))


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    points = rng.poisson(2, (150, jaccard.GROUPS)).astype(np.int32)
    points[75:] = np.maximum(points[:75] + (rng.random((75, jaccard.GROUPS)) < 0.1), 0)
    sizes, comp = points.sum(axis=1).astype(np.int64), rng.integers(0, 100, 150)
    tree = jaccard.RTree(points, sizes, comp, 85)
    got = {tuple(sorted(p)) for p in tree.pairs().tolist()}
    want = {(i, j) for j in range(150) for i in range(j) if comp[i] != comp[j] and 185 * np.minimum(points[i], points[j]).sum() >= 85 * (sizes[i] + sizes[j])}
    assert got == want and want and len(tree.best(tree.pairs())) <= 150


def test_tree_of_very_large_sets():
    """Sets of 20 million shingles: counts beyond 16 bits bound their overlap as they are."""
    points = np.full((3, jaccard.GROUPS), 78_125, np.int32)
    points[2] = 2
    tree = jaccard.RTree(points, np.array([20_000_000, 20_000_000, 512]), np.arange(3), 85)
    assert {tuple(sorted(p)) for p in tree.pairs().tolist()} == {(0, 1)}
    assert jaccard.point(np.zeros(100_000, np.uint64)).max() == 100_000


def test_two_texts_under_one_key_lose_no_link(spark):
    rng = random.Random(2)
    one, two = prose(rng, 80), prose(rng, 80)
    rows = [(1, one), (1, two), (2, two + " more"), (3, one + " still"), (None, prose(rng, 70)), (None, prose(rng, 70))]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted((r.doc_id or 9, r.component_id or 9) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (9, 9), (9, 9)]


def test_distinct_with_clashing_names(spark):
    rng = random.Random(3)
    t = [prose(rng, 60) for _ in range(3)]
    df = spark.createDataFrame([(i, x, 1, 2, "c") for i, x in enumerate([*t, t[0]])], "doc_id long, text string, _stays int, row int, key string")
    kept = jaccard.distinct(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]
    assert jaccard.distinct(df.limit(0)).count() == 0


def test_a_hot_tile_of_many_components(spark):
    """More members of a tile than a search holds: one large component and outsiders."""
    rng = random.Random(4)
    base = prose(rng, 200).split()
    texts = [" ".join([*base, f"x{i}"]) for i in range(60)] + [" ".join([*base[: 120 + i], *prose(rng, 70).split()]) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = [r.component_id for r in jaccard.join(df, 4, 60, chunk=5).orderBy("doc_id").collect()]
    assert got == brute_components(texts, 4, 60)[1]


def test_join_of_odd_rows(spark):
    got = jaccard.join(odd(spark)).collect()
    assert len(got) == len(ODD) and {r.component_id for r in got if r.doc_id == 4} == {4}
    assert jaccard.join(odd(spark).limit(0)).count() == 0
    kept = jaccard.distinct(odd(spark))
    assert kept.columns == odd(spark).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


#: Null ids, and ids that repeat, with texts of their own.
SHARED = [(None, 11), (None, 12), (None, 13), (7, 14), (7, 15), (7, 16), (8, 17), (9, 18)]


def shared_ids(spark):
    texts = [prose(random.Random(s), 40 + s) for _, s in SHARED]
    rows = [(i, t, f"s{n % 2}") for n, ((i, _), t) in enumerate(zip(SHARED, texts, strict=True))]
    rows += [(1, rows[1][1], "s0"), (5, rows[4][1], "s1"), (7, rows[3][1], "s1"), (None, rows[2][1], "s0")]
    return texts, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_distinct_keeps_every_text_of_shared_and_null_ids(spark):
    texts, df = shared_ids(spark)
    ids = [None, 1, None, 7, 5, 7, 8, 9]
    kept = jaccard.distinct(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, t) for i, t in zip(ids, texts, strict=True))


def test_mix_sources_copies_rows_not_ids(spark):
    import corpus_pipeline as p

    df = shared_ids(spark)[1].withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    want = mixing.mix(df).groupBy("size").agg(F.sum("copies").alias("n")).where("n > 0").collect()
    out = p.mix_sources(spark, df, "")
    got = out.groupBy(F.size(F.split("text", " ")).cast("long").alias("size")).count().collect()
    assert out.columns == df.columns and {r.size: r["count"] for r in got} == {r.size: r.n for r in want}
    source = {(r.doc_id, r.text): 0 for r in df.collect()}
    for r in df.collect():
        source[r.doc_id, r.text] += 1
    taken = defaultdict(int)
    for r in out.collect():
        taken[r.doc_id, r.text] += 1
    assert all(n <= 3 * source[k] for k, n in taken.items()) and any(i is None for i, _ in taken)


def test_packing_is_whole_and_tight(spark, corpus):
    from quire.llm.tokens import Encoder

    docs = [(i, t) for i, t in enumerate(corpus)] + [(1000, "long " * 700), (1000, "long " * 700)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("length", F.lit("clash"))
    got = packing.pack(df, tokenizer_path(), 256).toPandas()
    enc = Encoder(tokenizer_path())
    want = []
    for i, t in docs:
        ids = [*enc.library([t or ""])[0], 0]
        want += [(i, k // 256, k, len(ids[k : k + 256]), zlib.crc32(np.asarray(ids[k : k + 256], "<u4").tobytes())) for k in range(0, len(ids), 256)]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 256
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 256) + 1
    assert packing.pack(df.limit(0), tokenizer_path()).count() == 0 and packing.pack(odd(spark), tokenizer_path()).where("start = 0").count() == len(ODD)


def test_crossover_and_mutation_keep_every_item():
    rng = random.Random(3)
    counts = {rng.randint(1, 100): rng.randint(1, 9) for _ in range(40)}
    total = lambda p: {x: sum(n * k.count(x) for k, n in p.items()) for x in counts}
    a = packing.best_fit(counts, 100)
    b = packing.best_fit(counts, 100, order=sorted(counts))
    for _ in range(50):
        c = packing.mutate(packing.crossover(a, b, counts, 100, rng), counts, 100, rng)
        assert total(c) == counts and all(sum(k) <= 100 for k in c)
        a, b = c, a
    assert packing.size(packing.evolve([a], counts, 100, 5, 1, 4)[0]) <= packing.size(a)


def test_islands_beat_best_fit():
    """Lengths of which best fit, longest first, wastes a sequence in every few; crossover and migration find better."""
    counts = {36: 60, 35: 60, 29: 60, 50: 30, 45: 30, 5: 30, 27: 40, 24: 40, 49: 40}
    plain = packing.size(packing.best_fit(counts, 100))
    found = [packing.best_fit(counts, 100)]
    for epoch in range(6):
        found = packing.evolve(found, counts, 100, 10, epoch, 8)
    best = found[0]
    assert packing.size(best) < plain and all(sum(p) <= 100 for p in best)
    total = defaultdict(int)
    for p, n in best.items():
        for x in p:
            total[x] += n
    assert total == counts


def test_one_generation_at_least():
    counts = {50: 4}
    one = packing.best_fit(counts, 100)
    assert packing.evolve([dict(one)], counts, 100, 3, 1, 2)[0] == one
    assert packing.evolve([one], counts, 100, 3, 1, 2)[0] is not one


def test_mix_equals_sql(spark, corpus):
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 5}") for i, t in enumerate(corpus)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(df, bucket_docs=7).toPandas().sort_values("doc_id", ignore_index=True)
    documents = df.toPandas()  # noqa: F841
    want = duckdb.sql(mixing.ORACLE).df().sort_values("doc_id", ignore_index=True)
    for c in ("size", "source_size", "copies", "taken"):
        assert got[c].tolist() == want[c].tolist()
    assert np.allclose(got.target, want.target)
    source = {i: s for i, _, s in rows}
    by = got.assign(source=[source[i] or "" for i in got.doc_id]).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"), size=("source_size", "first"))
    assert ((by.taken - by.target).abs() <= by.largest / 2).all() and (by.target <= 3 * by["size"] + 1e-6).all() and abs(by.target.sum() - by["size"].sum()) < 1e-6
    assert (got.taken <= 3 * got["size"]).all()
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix(odd(spark)).count() == len(ODD)


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 10), (None, 5)], "source string, size long")
    t = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert t["b"] == 30 and t["c"] == 30 and t[None] == 15 and abs(t["a"] - 950) < 1e-9


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    x[700:] = x[rng.integers(0, 40, 800)] + rng.normal(size=(800, 16)) * 0.05
    x[::3] *= 2.0
    x[1200:1300] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, [1.0]), (20, x[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("part", F.lit("clash"))
    got = neighbours.neighbours(df, F.col("vec_id") % 20 == 0, k=10, chunk=300).toPandas()
    hits = []
    for q, g in got.groupby("query_id"):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:10]
        hits.append(len(set(order) & set(g.vec_id)))
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, len(g) + 1)) and np.allclose(g.score, s[g.vec_id], rtol=1e-12)
        assert all(a > b or a == b and i < j for a, b, i, j in zip(g.score[:-1], g.score[1:], g.vec_id[:-1], g.vec_id[1:], strict=False))
    assert np.mean(hits) >= 9 and got.query_id.nunique() == 75 and got.vec_id.max() < 1500
    assert neighbours.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.neighbours(df.where("vec_id in (20, 21, 22)"), F.col("vec_id") == 20).count() == 2


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect() if r.embedding is not None]
    ids, x = np.asarray([i for i, _ in rows]), np.asarray([v for _, v in rows], float)
    ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    ids, x = ids[ok], x[ok]
    got = neighbours.neighbours(df, F.col("vec_id") % 20 == 0, k=20).toPandas()
    hits = []
    for q, g in got.groupby("query_id"):
        s = (x * x[ids == q]).sum(axis=1)
        s[ids == q] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id)) / min(20, len(ids) - 1))
    assert np.mean(hits) >= 0.9 and got.query_id.nunique() == (ids % 20 == 0).sum()


def test_pipeline_stages_equal_plain_versions(spark, corpus, tmp_path):
    import corpus_pipeline as p
    from quire.llm import quality

    rng = random.Random(9)
    good = ["the of and to " + prose(rng, 60) for _ in range(30)]
    texts = good + [good[0], good[1] + " " + prose(rng, 2), "too short", None, "mail bob.x@mail.example.com the of and " + prose(rng, 60)]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in p.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        seen[name] = docs.toPandas()
        if name != p.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            assert set(seen[name].doc_id) == {r.doc_id for r in quality.score(before).where("kept").collect()} == {i for i, t in enumerate(texts) if t and len(t.split()) >= 50}
        if name == "near_duplicates":
            old = before.orderBy("doc_id").collect()
            comp = brute_components([r.text for r in old], 5, 80)[1]
            assert sorted(seen[name].doc_id) == sorted({old[c].doc_id for c in comp})
        if name == "personal_data":
            assert not any("bob.x" in t for t in seen[name].text) and (seen[name].n_chars == seen[name].text.str.len()).all()
        if name == "mix_sources":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert seen[name].doc_id.value_counts().to_dict() == {i: c for i, c in copies.items() if c}
        docs = spark.createDataFrame(seen[name], docs.schema)
    n = defaultdict(int)
    for r in seen["pack_sequences"].itertuples():
        n[r.doc_id] += r.start == 0
    assert n == seen["mix_sources"].doc_id.value_counts().to_dict()
    assert p.run(spark, str(tmp_path)).count() == len(seen["pack_sequences"])


def test_pipeline_of_nothing_and_of_odd_columns(spark, tmp_path):
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert p.run(spark, str(tmp_path / "a")).count() == 0
    text = "the of and to " + prose(random.Random(1), 80)
    rows = [(1, text, "en", None, 5, "x", "y", 7), (None, text + " more", None, None, None, None, None, None), (3, None, None, "s", None, None, None, None), (1, text, "en", None, 5, "x", "y", 7)]
    docs = spark.createDataFrame(rows, schema + ", row string, of string, copies long")
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [*schema.replace(" long", "").replace(" string", "").split(", "), "row", "of", "copies"], name
    assert docs.count() == 1 and p.STAGES[-1][1](spark, docs, "").count() == 1
