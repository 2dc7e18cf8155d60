"""Packing token sequences into as few training sequences as possible, with a grouping genetic algorithm.

Items of one length are interchangeable, so a packing of any corpus is a set of *patterns* (the lengths in one
sequence) with multiplicities, and the whole problem is the histogram of lengths: at most ``capacity`` rows
whatever the corpus. Islands evolve such packings in separate tasks; items get their places by their rank among
those of the same length.
"""

from __future__ import annotations

import math
import pickle
import random
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, small_batches, stable
from quire.llm.tokens import encoder

Packing = dict[tuple[int, ...], int]  # pattern, longest first -> number of sequences


def best_fit(counts: dict[int, int], capacity: int, open_bins: Packing | None = None, order: list[int] | None = None) -> Packing:
    """Place ``counts`` copies of each length, longest first unless ``order`` is given, where they leave least room.

    Copies are placed in blocks: as many as there are both copies and sequences of the pattern that fits best.
    A block uses up either a length or a pattern, so that at most two patterns are added for each length.
    """
    rooms: dict[int, dict[tuple[int, ...], int]] = {}
    mask = 0

    def put(pattern, n):
        nonlocal mask
        r = capacity - sum(pattern)
        at = rooms.setdefault(r, {})
        at[pattern] = at.get(pattern, 0) + n
        mask |= 1 << r

    for pattern, n in (open_bins or {}).items():
        put(pattern, n)
    for length in order or sorted(counts, reverse=True):
        left = counts.get(length, 0)
        while left > 0:
            fits = mask >> length
            if fits:
                r = length + (fits & -fits).bit_length() - 1
                pattern, n = next(iter(rooms[r].items()))
                k = min(n, left)
                if k == n:
                    del rooms[r][pattern]
                    if not rooms[r]:
                        del rooms[r]
                        mask &= ~(1 << r)
                else:
                    rooms[r][pattern] = n - k
                put(tuple(sorted((*pattern, length), reverse=True)), k)
                left -= k
            else:
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put((length,) * each, full)
                if rest:
                    put((length,) * rest, 1)
                left = 0
    return {p: n for at in rooms.values() for p, n in at.items()}


def size(p: Packing) -> int:
    return sum(p.values())


def fitness(p: Packing, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the more uneven fill: it leaves room where later moves can use it."""
    return -size(p), sum(n * (sum(k) / capacity) ** 2 for k, n in p.items())


def crossover(one: Packing, other: Packing, counts: dict[int, int], capacity: int, rng: random.Random) -> Packing:
    """Inject a share of one parent's well-filled sequences whole into the other; the other keeps its sequences as far
    as their items are still free, fullest first, and the displaced items are placed by best fit."""
    keys = sorted(one, key=lambda p: (-sum(p), p))
    cut = rng.uniform(0.3, 0.9)
    child: Packing = {}
    free = dict(counts)
    for p in keys[: max(1, int(len(keys) * cut))]:
        if rng.random() < 0.8:
            child[p] = one[p]
            for x, q in Counter(p).items():
                free[x] -= q * one[p]
    for p in sorted(other, key=lambda p: (-sum(p), p)):
        if sum(p) < capacity * 0.9:
            break
        need = Counter(p)
        k = min(other[p], *(free[x] // q for x, q in need.items()))
        if k > 0:
            child[p] = child.get(p, 0) + k
            for x, q in need.items():
                free[x] -= q * k
    return best_fit({x: n for x, n in free.items() if n > 0}, capacity, child)


def mutate(p: Packing, counts: dict[int, int], capacity: int, rng: random.Random) -> Packing:
    """Dissolve the emptiest sequences and a few others, and place their items in a slightly shuffled order."""
    gone: Counter[int] = Counter()
    kept: Packing = {}
    order = sorted(p, key=lambda k: (sum(k), k))
    worst = set(order[: max(1, len(order) // 20)])
    for k, n in p.items():
        m = n if k in worst else (rng.randint(0, n) if rng.random() < 0.05 else 0)
        if m:
            for x, q in Counter(k).items():
                gone[x] += q * m
        if n > m:
            kept[k] = n - m
    ordered = sorted(gone, key=lambda x: -x * rng.uniform(0.9, 1.0))
    return best_fit(gone, capacity, kept, ordered)


def evolve(population: list[Packing], counts: dict[int, int], capacity: int, generations: int, seed: int, keep: int, most_patterns: int | None = None) -> list[Packing]:
    """At least one generation and at most ``generations``, ending early at the lower bound. A child as good as its parents
    takes their place, so what comes out went through crossover wherever that did no harm. Children of more than
    ``most_patterns`` different patterns (8 for each token of capacity) aren't kept: that bounds a packing's size in memory
    and costs no items, as every packing that stays is a whole one."""
    rng = random.Random(seed)
    bound = -(-sum(x * n for x, n in counts.items()) // capacity)
    best = lambda pop: sorted(pop, key=lambda p: fitness(p, capacity), reverse=True)
    limit = most_patterns or 8 * capacity
    while len(population) < keep:
        noise = rng.uniform(0.0, 0.2)
        population.append(best_fit(counts, capacity, order=sorted(counts, key=lambda x: -x * (1 - rng.random() * noise))))
    population = best(population)
    for n in range(generations):
        if n and size(population[0]) <= bound:
            break
        children = []
        for _ in range(max(1, keep // 2)):
            a, b = rng.sample(population, 2) if len(population) > 1 else (population[0], population[0])
            child = crossover(a, b, counts, capacity, rng)
            if rng.random() < 0.5:
                child = mutate(child, counts, capacity, rng)
            if len(child) <= limit:
                children.append(child)
        population = best([*children, *population])[:keep]
    return population


def pack_histogram(spark, counts: dict[int, int], capacity: int, islands: int = 4, epochs: int = 3, generations: int = 6, keep: int = 6, seed: int = 7) -> Packing:
    """The best packing of a histogram that ``islands`` tasks find in ``epochs``, each island's elite moving on to the next
    one between them. Islands are rows (island, packing); what the driver gets in the end is one packing of bounded size."""
    counts = {int(x): int(n) for x, n in counts.items() if n > 0}
    if not counts:
        return {}
    given = spark.sparkContext.broadcast(counts)
    rows = spark.createDataFrame([(i, b"") for i in range(islands)], "island int, packing binary")
    bound = -(-sum(x * n for x, n in counts.items()) // capacity)
    for epoch in range(epochs):
        step = _epoch(given, capacity, generations, seed * 1_000_003 + epoch * 1009, keep)
        evolved = stable(rows.groupBy("island").applyInPandas(step, "island int, packing binary, place int, sequences long"), "islands")
        elite = evolved.where("place = 0")
        rows = evolved.select("island", "packing").union(elite.select(((F.col("island") + 1) % islands).cast("int").alias("island"), "packing"))
        best = elite.orderBy("sequences", "island").select("sequences", "packing").limit(1).collect()[0]
        if best.sequences <= bound and epoch:  # the elite has moved on at least once
            break
    given.unpersist()
    return pickle.loads(best.packing)


def _epoch(given, capacity: int, generations: int, seed: int, keep: int):
    def step(key, pdf: pd.DataFrame) -> pd.DataFrame:
        island = int(key[0])
        mine = [pickle.loads(b) for b in pdf.packing if len(b)]
        if not mine and island == 0:
            mine = [best_fit(given.value, capacity)]
        out = evolve(mine, given.value, capacity, generations, seed + island, keep)
        return pd.DataFrame({"island": island, "packing": [pickle.dumps(p) for p in out], "place": range(len(out)), "sequences": [size(p) for p in out]})

    return step


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, text: str = "text", key: str = "doc_id", end_id: int = 0) -> DataFrame:
    """Each document's ids and ``end_id``, cut every ``capacity`` ids: ``key, piece, start, length, ids_crc32``."""
    small_batches(docs.sparkSession)
    last = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        step = 4 * capacity
        for b in batches:
            rows = []
            for k, ids in zip(b.column(0).to_pylist(), enc.many_ids(b.column(1)), strict=True):
                ids += last
                rows += [(k, i // step, i // 4, (min(len(ids), i + step) - i) // 4, zlib.crc32(memoryview(ids)[i : i + step])) for i in range(0, len(ids), step)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (b.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["key", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body")).mapInArrow(cut, f"key {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def slots(p: Packing, first: int = 0) -> pd.DataFrame:
    """Where the items of each length go, by rank: ranks from ``rank`` on take ``each`` places in every sequence from ``seq`` on."""
    rows, used = [], Counter()
    for pattern in sorted(p, key=lambda k: (-sum(k), k)):
        n, at = p[pattern], 0
        for length, each in Counter(pattern).items():
            rows.append((length, used[length], each, first, at))
            used[length] += each * n
            at += each * length
        first += n
    return pd.DataFrame(rows, columns=["length", "rank", "each", "seq", "at"], dtype="int64").sort_values(["length", "rank"], ignore_index=True)


def ranked(pieces: DataFrame, counts: dict[int, int], key: str) -> DataFrame:
    """Adds ``rank``, from 0, among the pieces of the same length. A length that very many pieces have is dealt into
    buckets of bounded size, numbered separately and shifted by the counts of the buckets before."""
    spark = pieces.sparkSession
    total = sum(counts.values())
    target = max(1024, math.isqrt(total))
    many = {x: -(-n // target) for x, n in counts.items()}  # rows, not keys, are dealt: alike rows spread over buckets too
    buckets = F.element_at(F.create_map(*[F.lit(int(v)) for kv in sorted(many.items()) if kv[1] > 1 for v in kv]), F.col("length").cast("int")) if any(v > 1 for v in many.values()) else F.lit(1)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.coalesce(buckets, F.lit(1)).cast("long")))
    shift = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    shift = shift.withColumn("shift", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).drop("n")
    mine = Window.partitionBy("length", "bucket").orderBy(f"`{key}`", "piece", "start", "ids_crc32", "row")
    local = dealt.withColumn("local", F.row_number().over(mine) - 1)
    shift = bounded(shift, sum(many.values()), 64)
    return local.join(shift, ["length", "bucket"]).withColumn("rank", F.col("local") + F.col("shift")).drop("local", "shift", "bucket", "row")


def place(pieces: DataFrame, p: Packing, key: str) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ranked pieces; the plan has a bounded number of rows and is broadcast."""
    spark = pieces.sparkSession
    plan = slots(p)
    wide = np.int64(1) << 40
    given = spark.sparkContext.broadcast((plan.length.to_numpy() * wide + plan["rank"].to_numpy(), *(plan[c].to_numpy() for c in ("rank", "each", "seq", "at"))))
    types = {f.name: f.dataType for f in pieces.schema}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rank0, each, seq, at = given.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(keys, length * wide + rank, side="right") - 1
            j = rank - rank0[i]
            cols = [b.column(c) for c in (key, "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq[i] + j // each[i], pa.int64()), pa.array(at[i] + j % each[i] * length, pa.int64())], [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return pieces.select(f"`{key}`", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")).mapInArrow(find, f"`{key}` {types[key].simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, text: str = "text", key: str = "doc_id", end_id: int = 0, islands: int = 4, epochs: int = 3) -> DataFrame:
    """Packs whole documents: ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is its ``end_id`` alone; only documents above ``capacity`` ids are cut; a repeated row is
    packed once for each time it is there; other columns are left out; an empty table gives an empty one. Pieces go
    to the shared folder once, so that nothing is tokenized twice and ranks can't change when an executor is lost.
    """
    pieces = stable(token_pieces(docs, tokenizer, capacity, text, key, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    best = pack_histogram(docs.sparkSession, counts, capacity, islands, epochs)
    return place(ranked(pieces, counts, key), best, key)
