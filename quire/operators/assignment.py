"""Sequential and global assignments within one container, as pandas functions of a group.

A group is a page, a batch or a document: bounded by what one book holds, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame


def per_group(df: DataFrame, keys: list[str], columns: list[str], order: list[str | Column], schema: str, f: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """Apply ``f`` to each group's rows, tuples of ``columns`` in ``order``, and put its keys before each tuple it returns.

    Groups are laid out by one shuffle and a sort inside each partition, and met one after another in its batches: many
    small groups cost no data frame each, and a task holds one group at a time.
    """
    n = len(keys)
    names = [x.split()[0] for x in schema.split(",")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*[[None if x is pd.NA or x != x else x for x in b[c].tolist()] for c in b.columns], strict=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for k, g in groupby(rows(batches), key=lambda r: r[:n]):
            out += [(*k, *r) for r in f([r[n:] for r in g])]
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    laid = df.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, *columns)
    return laid.mapInPandas(run, schema)


def _types(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)


def greedy(candidates: DataFrame, keys: list[str], left: str, right: str, order: list[str]) -> DataFrame:
    """One-to-one pairs: left items in order of ``left`` take their best free right item by ``order`` (ascending)."""
    def pick(rows: list[tuple]) -> list[tuple]:
        used, served, out = set(), set(), []
        for a, b in rows:
            if a not in served and b not in used:
                served.add(a)
                used.add(b)
                out.append((a, b))
        return out

    return per_group(candidates, keys, [left, right], [left, *order, right], _types(candidates, [*keys, left, right]), pick)


def best_chain(options: list[tuple[int, int, tuple]]) -> list[int]:
    """The chain of options (entry, position, score) with increasing entry and non-decreasing position that is longest, then
    has the greatest sum of scores, then the least entries. Quadratic in the options of one document."""
    order = sorted(range(len(options)), key=lambda i: (options[i][0], options[i][1]))
    best: dict[int, tuple] = {}
    for i in order:
        e, p, s = options[i]
        top = None
        for j in order:
            if j in best and options[j][0] < e and options[j][1] <= p:
                cand = (best[j][0] + 1, tuple(a + b for a, b in zip(best[j][1], s, strict=True)), tuple(-x for x in best[j][3]) + (-e,), (*best[j][3], e), (*best[j][4], i))
                if top is None or cand[:3] > top[:3]:
                    top = cand
        alone = (1, tuple(s), (-e,), (e,), (i,))
        best[i] = alone if top is None or alone[:3] > top[:3] else top
    return list(max(best.values(), key=lambda b: b[:3])[4]) if best else []


def chains(options: DataFrame, keys: list[str], entry: str, position: str, scores: list[str]) -> DataFrame:
    def run(rows: list[tuple]) -> list[tuple]:
        return [rows[i][:2] for i in best_chain([(r[0], r[1], r[2:]) for r in rows])]

    return per_group(options, keys, [entry, position, *scores], [entry, position, *scores], _types(options, [*keys, entry, position]), run)


def resolve(entries: list[list[tuple[int, int | None, tuple]]]) -> list[int | None]:
    """The choice of at most one candidate (position, heading rank or None, objectives) for each entry, in entry order, for
    which positions don't fall and heading ranks rise, with the lexicographically greatest sum of objectives and then the
    least candidate numbers. An exact dynamic programme over the last position and rank; minimised objectives come negated."""
    width = next((len(c[2]) for e in entries for c in e), 0)
    states: dict[tuple[int, int], tuple] = {(-1, -1): ((0,) * width, (), ())}
    for cands in entries:
        nxt: dict[tuple[int, int], tuple] = {}

        def offer(key, value, nxt=nxt):
            if key not in nxt or value[:2] > nxt[key][:2]:
                nxt[key] = value

        for (pos, rank), (total, ranks, chosen) in states.items():
            offer((pos, rank), (total, (*ranks, -len(cands)), (*chosen, None)))
            for k, (p, r, obj) in enumerate(cands):
                if p >= pos and (r is None or r > rank):
                    offer((p, rank if r is None else r), (tuple(a + b for a, b in zip(total, obj, strict=True)), (*ranks, -k), (*chosen, k)))
        states = nxt
    return list(max(states.values(), key=lambda s: s[:2])[2])


def resolved(candidates: DataFrame, keys: list[str], entry: str, position: str, rank: str, objectives: list[str]) -> DataFrame:
    """resolve() for every group; candidates of an entry are numbered by position, those with a heading first, rank."""
    def run(rows: list[tuple]) -> list[tuple]:
        rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3:]))
        groups = [list(g) for _, g in groupby(rows, key=lambda r: r[0])]
        picks = resolve([[(int(r[1]), None if r[2] is None else int(r[2]), r[3:]) for r in g] for g in groups])
        return [g[k][:3] for g, k in zip(groups, picks, strict=True) if k is not None]

    out = per_group(candidates, keys, [entry, position, rank, *objectives], [entry], _types(candidates, [*keys, entry, position]) + f", {rank} double", run)
    return out.withColumn(rank, out[rank].cast(candidates.schema[rank].dataType))


def consolidate(rows: list[tuple]) -> list[tuple[int, list[int]]]:
    """Leader clustering of volumes (id, number, number confidence, date, date confidence), texts normalised: two passes, those
    with both texts first. A volume joins the first bag that accepts it; the surest one is the bag's root.

    A bag with both texts accepts a volume of which either text equals its own; one with a single text accepts a volume with
    the same text alone. Volumes without texts are dropped. Returns (root, members in order)."""
    both = [r for r in rows if r[1] is not None and r[3] is not None]
    single = [r for r in rows if (r[1] is None) != (r[3] is None)]
    sure = lambda r: (r[2] or 0.0) + (r[4] or 0.0)
    bags: list[list[tuple]] = []
    for r in [*both, *single]:
        for bag in bags:
            root = bag[0]
            whole, mine = root[1] is not None and root[3] is not None, r[1] is not None and r[3] is not None
            same = (r[1] is not None and r[1] == root[1]) or (r[3] is not None and r[3] == root[3])
            if same and (whole or not mine):
                if whole == mine and sure(r) > sure(root):
                    bag.insert(0, r)
                else:
                    bag.append(r)
                break
        else:
            bags.append([r])
    return [(b[0][0], sorted(x[0] for x in b)) for b in bags]


def bags(volumes: DataFrame, batch: str, ident: str, number: str, number_conf: str, date: str, date_conf: str) -> DataFrame:
    kind = volumes.schema[ident].dataType.simpleString()
    run = lambda rows: [(m, root) for root, members in consolidate(rows) for m in members]
    return per_group(volumes, [batch], [ident, number, number_conf, date, date_conf], [ident], f"{_types(volumes, [batch, ident])}, root {kind}", run)
