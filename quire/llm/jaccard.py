"""Similarity join on the word shingles of documents, by points of group counts in R-trees.

Shingles are hashed; consecutive ranges of hash values are groups, and a document's set is the point of its counts in
them. Two sets with few differences have equal contents in at least one of sufficiently many ranges of groups, so the
sets are first laid out in one tile for each range and content: the leaves below the root of a forest that tasks share.
Within a tile, trees over the points bound the overlap of two sets by the summed minima of their coordinates, and of two
boxes by those of their upper corners; pairs that the bound lets pass are verified on the sets themselves.

A linked pair shares more tiles than the one that it needs, so each set leaves the most frequent ones out: as many as leave
every link at least one tile, all sets in one order of tiles. What many documents have in common then lays few of them in
one tile.

A tile's sets are first compared with one pivot each; the components of these links are then left out of the trees'
comparisons, which look only for links between different components: first for each set's most promising one, then, with
what that has joined, for all that are left. So a group of any number of near copies costs about as many comparisons as it
has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, discard, small_batches, stable

GROUPS = 256
LEAF = 16
#: The bits of a tile that name its level.
LEVEL = 63
#: Bytes of texts that are hashed at a time (about 60 times as many are held then), tiles that a task compares with each
#: other before they are shuffled, documents among them at most, entries that one step of the meeting task holds, and
#: entries of one row.
SLICE, CHUNK_TILES, CHUNK_DOCS, STEP_TILES, BLOB = 1 << 18, 1 << 20, 1 << 16, 1 << 20, 1 << 14
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S32 = (np.uint64(x) for x in (30, 27, 31, 32))
_POWERS = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 64), _P, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def _word_hashes(raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another and end at ``ends``, and where each text's words begin."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[0] = True
    first[ends] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    at = np.arange(len(data), dtype=np.int64) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    at[~word] = 0
    return mixed(np.add.reduceat(np.where(word, (data.astype(np.uint64) + np.uint64(1)) * _powers(int(at.max()) + 1)[at], np.uint64(0)), starts)), bounds


def _long_text(raw: bytes) -> np.ndarray:
    """Hashes of the words of one text, about SLICE bytes at a time, cut at white space."""
    spaces = np.flatnonzero(_SPACE[np.frombuffer(raw, np.uint8)])
    at = np.searchsorted(spaces, np.arange(SLICE, len(raw), SLICE))
    cuts = [0, *np.unique(spaces[at[at < len(spaces)]]).tolist(), len(raw)]
    return np.concatenate([_word_hashes(raw[a:b], np.asarray([b - a]))[0] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``k`` words; a shorter text's words are one.

    Beside the hashes of a text's words no more than about SLICE bytes of texts (or one longer word) are worked on at a time.
    """
    salts = mixed(np.arange(1, k + 1, dtype=np.uint64) * _P) | np.uint64(1)
    out: list[np.ndarray] = []
    some: list[bytes] = []

    def sets() -> None:
        ends = np.cumsum([len(r) for r in some], dtype=np.int64)
        h, bounds = (_long_text(some[0]), None) if len(some) == 1 and len(some[0]) > SLICE else _word_hashes(b"".join(some), ends)
        bounds = np.asarray([0, len(h)]) if bounds is None else bounds
        some.clear()
        full = mixed(sum(h[j : len(h) - k + 1 + j] * salts[j] for j in range(k))) if len(h) >= k else h[:0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            n = b - a
            if n >= k:
                out.append(np.unique(full[a : b - k + 1]))
            elif n:
                out.append(mixed(np.atleast_1d((h[a:b] * salts[:n]).sum(dtype=np.uint64) + np.uint64(n))))
            else:
                out.append(np.empty(0, np.uint64))

    held = 0
    for t in texts:
        raw = (t or "").encode()
        if some and held + len(raw) > SLICE:
            sets()
            held = 0
        some.append(raw)
        held += len(raw)
    if some:
        sets()
    return out


def levels(percent: int, top: int, ratio: float = 1.6) -> list[tuple[int, int, int]]:
    """Ranges of set sizes, each as (first size, differences at most, tiles). Two linked sets of which the larger lies in a
    range have at most so many differences between them, so at least ``tiles - differences`` tiles agree. A third more tiles
    than that needs keeps most sets from having so few that empty ranges count, and leaves them some to spare."""
    out, first = [], 1
    while first <= top:
        nxt = max(first + 1, int(first * ratio))
        most = 2 * (nxt - 1) * (100 - percent) // (100 + percent)
        out.append((first, most, most + 1 + (1 + most // 3 if most else 0)))
        first = nxt
    return out[: LEVEL + 1]


def tiles(u: np.ndarray, percent: int, table: list[tuple[int, int, int]], firsts: np.ndarray) -> np.ndarray:
    """A set's tiles: one for each range of groups with something in it, at its own level and at those of larger partners.
    Ranges without anything count as tiles too where so many are empty that a link might show in those alone. The last six
    bits of a tile are its level."""
    return tiles_and_spares(u, percent, table, firsts)[0]


def tiles_and_spares(u: np.ndarray, percent: int, table: list[tuple[int, int, int]], firsts: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The tiles of a set, and its first level followed by how many tiles it can spare at that level and at the next ones.

    Of c ranges with something in them a partner's differences spoil as many as there are at most, so c less those are
    shared. Without the c - differences - 1 greatest of its tiles, in an order that holds for all sets, a set still has the
    least tile that both share; where ranges without anything count, none is spared.
    """
    n = len(u)
    lo = int(np.searchsorted(firsts, n, side="right")) - 1
    hi = int(np.searchsorted(firsts, 100 * n // percent, side="right")) - 1
    out, m, spares = [], mixed(u + _P), [lo]
    for lev in range(lo, hi + 1):
        _, most, number = table[lev]
        block = ((u >> _S32) * np.uint64(number)) >> _S32
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        salt = mixed(np.asarray([lev * 1_000_003 + 17], np.uint64))[0]
        own = [mixed(np.add.reduceat(m, cut) + mixed(block[cut] + salt))]
        if number - len(cut) >= number - most:
            empty = np.setdiff1d(np.arange(number, dtype=np.uint64), block[cut])
            own.append(mixed(mixed(empty + salt) ^ _M1))
        out += [t & ~np.uint64(LEVEL) | np.uint64(lev) for t in own]
        spares.append(max(0, len(cut) - most - 1))
    return np.concatenate(out), spares


def point(u: np.ndarray) -> np.ndarray:
    """Counts of a set's hashes in GROUPS groups."""
    return np.bincount((mixed(u ^ _M2) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A point in half a byte a group, or one, two or four bytes, as its greatest count needs."""
    top = int(counts.max())
    if top < 16:
        return (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def unpacked(points: list[bytes]) -> np.ndarray:
    """The points of ``packed``, one in a row."""
    size = np.asarray([len(p) for p in points], np.int64)
    out = np.empty((len(points), GROUPS), np.int32)
    for s in np.unique(size).tolist():
        at = np.flatnonzero(size == s)
        raw = b"".join([points[i] for i in at.tolist()])
        if s < GROUPS:
            half = np.frombuffer(raw, np.uint8).reshape(-1, s)
            out[at[:, None], np.arange(0, GROUPS, 2)], out[at[:, None], np.arange(1, GROUPS, 2)] = half & 15, half >> 4
        else:
            out[at] = np.frombuffer(raw, f"<u{s // GROUPS}").reshape(-1, GROUPS)
    return out


def node_of(u: np.ndarray) -> int:
    """A set's 64-bit fingerprint."""
    return int(mixed(u * _M1 + _P).sum(dtype=np.uint64).astype(np.int64))


class Chunk:
    """Tiles of some documents of one task, brought together before they are shuffled.

    Of the documents of a chunk that share a tile only one goes on with it; the others are noted as members beside it. So a
    tile that very many documents share is shuffled once for each chunk, not once for each document.
    """

    def __init__(self, spots: int, subs: int):
        self.spots, self.subs = spots, subs
        self.clear()

    def clear(self) -> None:
        self.nodes: list[int] = []
        self.tiles: list[np.ndarray] = []
        self.seen: set[int] = set()
        self.n = 0

    def add(self, node: int, t: np.ndarray) -> None:
        self.seen.add(node)
        self.nodes.append(node)
        self.tiles.append(t)
        self.n += len(t)

    def full(self) -> bool:
        return self.n >= CHUNK_TILES or len(self.nodes) >= CHUNK_DOCS

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        """(spot, sub, blob): entries for each of the spots x subs parts that tiles are dealt to by their upper halves, and
        members of what the chunk joined (sub -1), spread over all spots."""
        if not self.n:
            return self.clear()
        t = np.concatenate(self.tiles)
        d = np.repeat(np.arange(len(self.nodes)), [len(x) for x in self.tiles])
        node = np.asarray(self.nodes, np.int64)
        self.clear()
        order = np.argsort(t)
        t, d = t[order], d[order]
        first = np.concatenate([[True], t[1:] != t[:-1]])
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(t)))
        parts = self.spots * self.subs
        part = ((t >> _S32) * np.uint64(parts)) >> _S32
        name = ((part << _S32) | (t & np.uint64(0xFFFFFFFF))).astype(np.int64)
        if (size > 1).any():
            joined = np.repeat(size > 1, size)
            local = np.stack([name[joined], node[d[joined]]], axis=1)
            for i in range(0, len(local), BLOB):
                yield (int(local[i, 0]) + i // BLOB) % self.spots, -1, local[i : i + BLOB].tobytes()
        low, d, part = (t[first] & np.uint64(0xFFFFFFFF)).astype("<u4"), d[first], part[first].astype(np.int64)
        order = np.argsort(part * len(node) + d, kind="stable")
        low, d, part = low[order], d[order], part[order]
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            spot, sub = divmod(int(part[a]), self.subs)
            for i in range(a, b, BLOB):
                e = min(b, i + BLOB)
                at = np.flatnonzero(np.concatenate([[True], d[i + 1 : e] != d[i : e - 1]]))
                count = np.diff(np.append(at, e - i)).astype("<u2")
                yield spot, sub, b"".join([np.asarray([len(at)], "<u4").tobytes(), node[d[i:e][at]].tobytes(), count.tobytes(), low[i:e].tobytes()])


def _entries(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lower halves of tiles and the node of each, out of a blob of Chunk."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    nodes = np.frombuffer(blob, np.int64, n, 4)
    count = np.frombuffer(blob, "<u2", n, 4 + 8 * n)
    return np.frombuffer(blob, "<u4", -1, 4 + 10 * n), np.repeat(nodes, count)


def laid(docs: DataFrame, k: int, percent: int, key: str, text: str, top: int = 1 << 40) -> DataFrame:
    """Two kinds of rows in one table: a row for each document, ``key, n, node, spares`` (the size of its set, the set's
    fingerprint, null if it is empty, and what it can spare), and, where ``tile`` isn't null, the members of every tile that
    two or more different sets share, ``node, tile``, some of them twice.

    Texts are hashed once and tiles shuffled once, packed into blobs. Tasks meet the entries part by part, in the order of a
    sort that may spill, so that memory holds about STEP_TILES of them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    spots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    chars = body.agg(F.sum(F.length("body"))).first()[0] or 0
    subs = max(1, -(-(chars // 10) // (spots * STEP_TILES)))  # a tile for about every ten characters
    names, counts = ["spot", "sub", "key", "n", "node", "spares", "blob"], pa.list_(pa.int32())

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels(percent, top)
        firsts = np.asarray([f for f, _, _ in table])
        task = TaskContext.get()
        chunk, turn = Chunk(spots, subs), task.partitionId() if task else 0

        def sent(ktype):
            rows = list(chunk.rows())
            for i in range(0, len(rows), 256):
                spot, sub, blob = zip(*rows[i : i + 256], strict=True)
                none = pa.nulls(len(spot), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(spot, pa.int32()), pa.array(sub, pa.int32()), pa.nulls(len(spot), ktype), none, none, pa.nulls(len(spot), counts), pa.array(blob, pa.binary())], names)

        ktype = None
        for b in batches:
            ktype = b.column(0).type
            n, node, spares = [], [], []
            for u in shingle_sets(b.column(1).to_pylist(), k):
                n.append(len(u))
                node.append(node_of(u) if len(u) else None)
                own, spare = tiles_and_spares(u, percent, table, firsts) if len(u) else (None, None)
                spares.append(spare)
                if len(u) and node[-1] not in chunk.seen:
                    chunk.add(node[-1], own)
                    if chunk.full():
                        yield from sent(ktype)
            turn += 1
            yield pa.RecordBatch.from_arrays([pa.array([turn % spots] * len(n), pa.int32()), pa.array([-1] * len(n), pa.int32()), b.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(spares, counts), pa.nulls(len(n), pa.binary())], names)
        if ktype is not None:
            yield from sent(ktype)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot = held = None
        blobs: list[bytes] = []
        ktype = None

        def members(rows: np.ndarray):
            none = pa.nulls(len(rows), pa.int64())
            return pa.RecordBatch.from_arrays([pa.nulls(len(rows), ktype), none, pa.array(rows[:, 1]), pa.nulls(len(rows), counts), pa.array(rows[:, 0])], ["key", "n", "node", "spares", "tile"])

        def shared():
            if not blobs:
                return
            low, node = (np.concatenate(x) for x in zip(*map(_entries, blobs), strict=True))
            blobs.clear()
            order = np.argsort(low)
            low, node = low[order], node[order]
            begin = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            size = np.diff(np.append(begin, len(low)))
            more = np.minimum.reduceat(node, begin) != np.maximum.reduceat(node, begin)
            there = np.repeat(more, size)
            part = np.int64(held[0]) * subs + held[1]
            rows = np.stack([(part << 32) | low[there].astype(np.int64), node[there]], axis=1)
            for i in range(0, len(rows), 1 << 18):
                yield members(rows[i : i + (1 << 18)])

        for b in batches:
            ktype = b.column(2).type
            sub = b.column(1).to_numpy()
            signed = b.filter(b.column(6).is_null())
            if len(signed):
                yield pa.RecordBatch.from_arrays([*signed.columns[2:6], pa.nulls(len(signed), pa.int64())], ["key", "n", "node", "spares", "tile"])
            for i, (spot, s, blob) in enumerate(zip(b.column(0).to_pylist(), sub.tolist(), b.column(6), strict=True)):
                if not blob.is_valid:
                    continue
                raw = blob.as_buffer()
                if s < 0:
                    yield members(np.frombuffer(raw, np.int64).reshape(-1, 2))
                    continue
                if held != (spot, s):
                    yield from shared()
                    held = (spot, s)
                blobs.append(raw)
        yield from shared()

    entries = body.mapInArrow(lay, f"spot int, sub int, key {kind}, n long, node long, spares array<int>, blob binary")
    met = entries.repartitionById(spots, F.col("spot")).sortWithinPartitions("sub").mapInArrow(meet, f"key {kind}, n long, node long, spares array<int>, tile long")
    return stable(met, "laid")


def rarest(met: DataFrame) -> DataFrame:
    """``tile, node`` of the members in ``laid`` without the most frequent tiles of each set, as many as it can spare.

    Frequent are tiles of many rows, the greater of equal ones more so: one order for all sets, with unshared tiles, which
    have no rows, at its lower end. A frequent tile is no window's key; those are sets, which have bounded numbers of tiles.
    """
    members = met.where("tile is not null").select("tile", "node")
    spares = met.where("tile is null and node is not null").select(F.col("node").alias("its"), "spares").dropDuplicates(["its"])
    level = F.col("tile").bitwiseAND(LEVEL).cast("int")
    rows = members.join(members.groupBy("tile").agg(F.count(F.lit(1)).alias("rows")), "tile").join(spares, F.col("node") == F.col("its"))
    rows = rows.withColumn("spare", F.get("spares", level - F.get("spares", F.lit(0)) + 1)).select("tile", "node", "rows", "spare")
    rows = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("node", level).orderBy(F.desc("rows"), F.desc("tile"))))
    return stable(rows.where("nth > spare").select("tile", "node").distinct(), "rarest")


def points_of(docs: DataFrame, k: int) -> DataFrame:
    """``node, n, point`` of texts given as ``body``, the point as ``packed`` has it; texts without words have no row."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us = [u for u in shingle_sets(b.column(0).to_pylist(), k) if len(u)]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(u) for u in us], pa.int64()), pa.array([len(u) for u in us], pa.int64()), pa.array([packed(point(u)) for u in us], pa.binary())], ["node", "n", "point"])

    return docs.select("body").mapInArrow(make, "node long, n long, point binary")


class Sets:
    """The sets of nodes, made from the texts again whenever they are needed: they would be larger than the texts."""

    def __init__(self, body: DataFrame, chosen: DataFrame, k: int):
        self.body, self.chosen, self.k = body, chosen, k

    def texts(self, nodes: DataFrame, n: int) -> DataFrame:
        """Texts of at most ``n`` nodes (and others of the same key)."""
        keys = self.chosen.join(bounded(nodes, n, 16), "node", "left_semi").select("least").distinct()
        return self.body.join(bounded(keys, n, 48), F.col("key").eqNullSafe(F.col("least")), "left_semi")

    def members(self, nodes: DataFrame, n: int) -> DataFrame:
        """``node, n, members`` of ``nodes``; of texts that share a key, also of others."""
        return self._made(nodes, n, "members array<long>", pa.list_(pa.int64()), lambda u: u.astype(np.int64))

    def groups(self, nodes: DataFrame, n: int) -> DataFrame:
        """Like ``members``, with the sorted numbers of 65,536 groups in place of the set, two bytes for each shingle."""
        return self._made(nodes, n, "groups binary", pa.binary(), lambda u: np.sort((mixed(u ^ _M1) >> np.uint64(48)).astype("<u2")).tobytes())

    def _made(self, nodes: DataFrame, n: int, column: str, kind: pa.DataType, of) -> DataFrame:
        k, name = self.k, column.split()[0]

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[int] = set()
            for b in batches:
                us = [u for u in shingle_sets(b.column(0).to_pylist(), k) if len(u)]
                names = [node_of(u) for u in us]
                new = [i for i, x in enumerate(names) if x not in done and not done.add(x)]
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in new], pa.int64()), pa.array([len(us[i]) for i in new], pa.int64()), pa.array([of(us[i]) for i in new], kind)], ["node", "n", name])

        return self.texts(nodes, n).select("body").mapInArrow(make, f"node long, n long, {column}")


def narrowed(pairs: DataFrame, n: int, sets: Sets, percent: int) -> DataFrame:
    """Those of ``n`` pairs (a, b) that a much finer point lets pass, 65,536 groups, as a table: it is sent as the sorted
    group numbers of a set, two bytes for each shingle, a quarter of the set itself."""
    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, None
        for b in batches:
            keep = []
            for a, na, nb, ga, gb in zip(*(b.column(c).to_pylist() for c in ("a", "na", "nb", "ga", "gb")), strict=True):
                if a != held:
                    held, counts = a, np.bincount(np.frombuffer(ga, "<u2"), minlength=1 << 16)
                group, size = np.unique(np.frombuffer(gb, "<u2"), return_counts=True)
                keep.append((100 + percent) * int(np.minimum(counts[group], size).sum()) >= percent * (na + nb))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    ends = pairs.select(F.col("b").alias("node"), "a")
    hubs = pairs.select(F.col("a").alias("node")).distinct()
    sent = sets.groups(ends.select("node").distinct(), n).join(bounded(ends, n, 32), "node").toDF("b", "nb", "gb", "a")
    ga = sets.groups(hubs, n).join(bounded(hubs, n, 16), "node", "left_semi").toDF("a", "na", "ga")
    return stable(sent.join(ga, "a").select("a", "b", "na", "nb", "ga", "gb").mapInArrow(passes, "a long, b long").distinct(), "narrowed")


class RTree:
    """A bulk-loaded tree of points: leaves of LEAF points of like component, size and counts, boxes above them.

    A box has the greatest count of its points in every group, their least size, and their component if it is one.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, component: np.ndarray, percent: int):
        self.percent, self.sizes, self.component = percent, sizes, component
        self.points = points
        order = np.lexsort((self.points[:, 1], self.points[:, 0], sizes, component)) if len(points) else np.empty(0, np.int64)
        groups = [order[i : i + LEAF] for i in range(0, len(order), LEAF)]
        self.levels = [self._boxes(groups, self.points, sizes, component, component)]
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            self.levels.append(self._boxes([np.arange(i, min(i + LEAF, len(below[0]))) for i in range(0, len(below[0]), LEAF)], *below[1:]))

    @staticmethod
    def _boxes(groups, upper, least, first, last):
        if not groups:
            return groups, upper, least, first, last
        return groups, np.stack([upper[g].max(axis=0) for g in groups]), *(np.asarray([f(x[g]) for g in groups]) for f, x in ((np.min, least), (np.min, first), (np.max, last)))

    def _reach(self, a, b, upper, least) -> np.ndarray:
        """Which of a x b may hold a link, by the summed minima of their coordinates."""
        return (100 + self.percent) * np.minimum(upper[a][:, None], upper[b][None]).sum(axis=2, dtype=np.int64) >= self.percent * (least[a][:, None] + least[b][None])

    def pairs(self) -> np.ndarray:
        """Pairs of points of different components whose bound reaches the overlap that a link needs."""
        found, todo = [], [(len(self.levels) - 1, 0, 0)] if len(self.sizes) else []
        while todo:
            lev, i, j = todo.pop()
            groups, _, _, first, last = self.levels[lev]
            if first[i] == last[i] == first[j] == last[j]:
                continue
            a, b = groups[i], groups[j]
            if lev:
                ok = self._reach(a, b, *self.levels[lev - 1][1:3])
                todo += [(lev - 1, int(a[x]), int(b[y])) for x, y in np.argwhere(ok) if i != j or x <= y]
                continue
            ok = (self.component[a][:, None] != self.component[b][None]) & self._reach(a, b, self.points, self.sizes)
            x, y = np.nonzero(np.triu(ok, 1) if i == j else ok)
            found.append(np.stack([a[x], b[y]], axis=1))
        return np.concatenate(found) if found else np.empty((0, 2), np.int64)

    def best(self, pairs: np.ndarray) -> np.ndarray:
        """Of each point's pairs the one with the greatest bound on the similarity."""
        if not len(pairs):
            return pairs
        bound = np.concatenate([np.minimum(self.points[p[:, 0]], self.points[p[:, 1]]).sum(axis=1) for p in np.array_split(pairs, len(pairs) // 4096 + 1)])
        share = bound / (self.sizes[pairs[:, 0]] + self.sizes[pairs[:, 1]])
        keep = set()
        for side in (0, 1):
            order = np.lexsort((pairs[:, 1 - side], -share, pairs[:, side]))
            at = pairs[order, side]
            keep.update(order[np.concatenate([[True], at[1:] != at[:-1]])].tolist())
        return pairs[sorted(keep)]


def exact(pairs: DataFrame, n: int, sets: Sets, percent: int) -> DataFrame:
    """Those of ``n`` pairs (a, b) of nodes that are links, compared on the sets themselves, as a table. The set of b goes to
    that of a; each set of a goes there once."""
    ends = pairs.select(F.col("b").alias("node"), "a")
    hubs = pairs.select(F.col("a").alias("node")).distinct()
    sent = sets.members(ends.select("node").distinct(), n).join(bounded(ends, n, 32), "node").toDF("b", "nb", "mb", "a")
    hubs = sets.members(hubs, n).join(bounded(hubs, n, 16), "node", "left_semi").toDF("a", "na", "ma")
    return stable(sent.join(hubs, "a").where((100 + percent) * F.size(F.array_intersect("ma", "mb")) >= percent * (F.col("na") + F.col("nb"))).select("a", "b").distinct(), "links")


def verified(pairs: DataFrame, points: DataFrame, sets: Sets, labels: DataFrame | None, percent: int) -> DataFrame | None:
    """The components (node, component) that the links among ``pairs`` (a, b) make together with those of ``labels``; None if
    there is no link at all.

    Pairs of too different sizes go first, then those that the bound on their points sorts out. Then every b is compared
    with its most promising a; of what is left only pairs between components that are still apart are compared.
    """
    size = points.select("node", "n")
    alike = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = np.minimum(*(unpacked(b.column(c).to_pylist()) for c in ("pa", "pb"))).sum(axis=1, dtype=np.int64)
            both = b.column("na").to_numpy() + b.column("nb").to_numpy()
            out = pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(most / both, pa.float64())], ["a", "b", "share"])
            yield out.filter(pa.array((100 + percent) * most >= percent * both))

    near = alike.join(points.select(F.col("node").alias("a"), F.col("point").alias("pa")), "a").join(points.select(F.col("node").alias("b"), F.col("point").alias("pb")), "b")
    near = stable(near.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(bound, "a long, b long, share double").distinct(), "near")
    first = stable(near.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a")).select("a", "b"), "first")
    for step in (first, near):
        todo, n = step, step.count()
        if step is near:
            if n == first.count():
                break
            todo = near.join(first, ["a", "b"], "left_anti").select("a", "b")
            if labels is not None:
                known = bounded(labels, labels.count(), 40)
                todo = todo.join(known.toDF("a", "x"), "a", "left").join(known.toDF("b", "y"), "b", "left").where(~F.coalesce(F.col("x") == F.col("y"), F.lit(False))).select("a", "b")
            every = stable(todo, "todo")
            n = every.count()
            todo = narrowed(every, n, sets, percent) if n else every
            if n:
                discard(every)
                n = todo.count()
        found = exact(todo, n, sets, percent) if n else None
        if found is not None and not found.isEmpty():
            old = labels
            every = found if labels is None else found.union(labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b")))
            labels = components(every)
            discard(old)
        discard(found)
        if step is near:
            discard(todo)
    discard(near, first)
    return labels


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of undirected ``links`` (a, b): repeated hooking to the least neighbour, with
    links contracted to what is still apart, until none is left. Each round's tables go to the shared folder, and those of
    the round before leave it."""
    links = stable(links.distinct(), "links")
    labels = stable(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("component", F.col("node")), "labels")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        first = parent = stable(parent, "parents")
        n = parent.count()
        for _ in range(2):
            up = bounded(parent.toDF("pa", "pp"), n, 24)
            parent = parent.join(up, F.col("p") == F.col("pa")).select("a", F.col("pp").alias("p"))
        parent = stable(parent, "parents")
        up = bounded(parent, n, 24)
        old = labels, links
        labels = stable(labels.join(up, F.col("component") == F.col("a"), "left").select("node", F.coalesce("p", "component").alias("component")), "labels")
        moved = links.join(up.toDF("a", "x"), "a").join(up.toDF("b", "y"), "b").where("x <> y")
        links = stable(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        discard(first, parent, *old)
    discard(links)
    return labels


def _across(percent: int, best: bool):
    """Rows of one search (tile, x, y) come one after another; each search is one tree."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows)
            node, n, component = (t.column(c).to_numpy() for c in ("node", "n", "component"))
            tree = RTree(unpacked(t.column("point").to_pylist()), n, component, percent)
            p = tree.pairs()
            if best:
                p = tree.best(p)
            a, b = node[p[:, 0]], node[p[:, 1]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        held, name = [], None
        for b in batches:
            if not len(b):
                continue
            ids = np.stack([b.column(c).to_numpy() for c in ("tile", "x", "y")], axis=1)
            edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1), [True]])).tolist()
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if name != (now := tuple(ids[i].tolist())):
                    if held:
                        yield found(held)
                    held, name = [], now
                held.append(b.slice(i, j - i))
        if held:
            yield found(held)

    return search


def _crossing(members: DataFrame, points: DataFrame, labels: DataFrame, n: int, percent: int, chunk: int, best: bool) -> DataFrame:
    """Pairs of different components within a tile that the trees let pass, all of them or each set's best.

    Tiles of equal members are searched once. One of more than ``chunk`` members is dealt into cells: a component of more
    than ``chunk`` has cells of its own, the others share some, and cells are searched two by two, but for two of the same
    component. So of a large group of near copies only its few outsiders are compared with it, not its members with each
    other.
    """
    known = members
    if labels is None:
        labels = known.select("node", F.col("node").alias("component")).limit(0)
    known = known.join(bounded(labels, n, 40), "node", "left").select("tile", "node", F.coalesce("component", "node").alias("component"))
    tiles_ = known.groupBy("tile").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2"))
    open_tiles = stable(tiles_.where("c1 <> c2 and size > 2").groupBy("size", "s1", "s2").agg(F.min("tile").alias("tile")).select("tile", "size"), "open")
    inside = stable(known.join(bounded(open_tiles, open_tiles.count(), 32), "tile"), "inside")
    small = inside.where(F.col("size") <= chunk).select("tile", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "node", "component")
    wide = inside.where(F.col("size") > chunk)
    own = wide.groupBy("tile", "component").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > chunk).withColumnRenamed("tile", "t2").withColumnRenamed("component", "c2")
    wide = wide.join(own, (F.col("tile") == F.col("t2")) & (F.col("component") == F.col("c2")), "left").drop("t2")
    mixed_cell = F.pmod(F.xxhash64("component", F.lit(2)), F.ceil(F.col("size") / chunk))
    cell = F.when(F.col("m").isNull(), mixed_cell).otherwise(F.xxhash64("component", F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("m") / chunk))))
    wide = stable(wide.select("tile", "node", "component", F.col("c2").alias("whole"), cell.alias("cell")), "wide")
    cells = wide.select("tile", "cell", "whole").distinct()
    two = cells.toDF("tile", "x", "wx").join(cells.toDF("tile", "y", "wy"), "tile").where("x <= y and not coalesce(wx = wy, false)").select("tile", "x", "y")
    large = wide.withColumnRenamed("cell", "x").join(two, ["tile", "x"]).unionByName(wide.withColumnRenamed("cell", "y").join(two.where("x < y"), ["tile", "y"]))
    searches = small.unionByName(large.select("tile", "x", "y", "node", "component")).join(points, "node")
    laid_out = searches.repartition("tile", "x", "y").sortWithinPartitions("tile", "x", "y")
    out = stable(laid_out.mapInArrow(_across(percent, best), "a long, b long").distinct(), "crossing")
    discard(open_tiles, inside, wide)
    return out


def join(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", chunk: int = 1024) -> DataFrame:
    """Links documents of which 100 * shared >= ``percent`` * all of their distinct shingles of ``k`` words are common:
    ``key, n_shingles, component_id`` (the least key that links lead to, itself included).

    Words are separated by space and the control characters 09 to 0D; A-Z count as a-z. A text with fewer than ``k`` words
    is one shingle; null, empty and blank texts have none and link with nothing. Equal sets are one class, whose copies
    are never compared; no link between different sets is lost, as the tiles cover every pair that may reach ``percent``.
    Repeated rows and ties come out one by one; different texts under one key, or under none, are documents of their own; a
    null key counts as the greatest; other columns, whatever their names, are left out; an empty table gives an empty one.
    Shingles and sets are known by 64-bit hashes.

    Shuffled are the tiles (about half of one for each shingle, 5 to 13 bytes each) and the sets of documents that share one.
    """
    met = laid(docs, k, percent, key, text)
    signed, members = met.where("tile is null").select("key", "n", "node"), rarest(met)
    least = members.groupBy("tile").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("tile", "a")
    pivots = stable(members.join(least, "tile").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "pivots")
    nodes = pivots.select(F.col("a").alias("node")).union(pivots.select("b")).distinct()

    classes = signed.where("node is not null").groupBy("node").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    chosen = stable(classes.join(nodes, "node", "left_semi"), "chosen")
    n = chosen.count()
    body = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    sets = Sets(body, chosen, k)
    points = stable(points_of(sets.texts(chosen.select("node"), n), k), "points")
    if points.count() != n:  # several texts under one key: sets that share no tile, or that are there twice
        every = points
        points = stable(every.join(bounded(chosen.select("node"), n, 16), "node", "left_semi").dropDuplicates(["node"]), "points")
        discard(every)

    labels = verified(pivots, points, sets, None, percent)
    tried = [pivots]
    for best in (True, False):
        found = _crossing(members, points, labels, n, percent, chunk, best)
        for t in tried:
            found = found.join(t, ["a", "b"], "left_anti")
        tried.append(stable(found, "crossing"))
        labels = verified(tried[-1], points, sets, labels, percent)
    discard(points, *tried)

    if labels is None:
        labels = chosen.select("node", F.col("node").alias("component")).limit(0)
    home = labels.join(chosen.select("node", "least"), "node")
    home = home.join(home.groupBy("component").agg(F.min("least").alias("id")), "component").select("node", "id")
    same = classes.join(home, "node", "left").where("copies > 1 or id is not null").select(F.col("node").alias("its"), F.coalesce("id", "least").alias("id"))
    out = stable(signed.join(same, F.col("node") == F.col("its"), "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("id", "key").alias("component_id")), "joined")
    discard(met, members, chosen, labels)
    return out


def distinct(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of least key of every component, with all its columns, whatever their names; its repeated rows count as one.

    Rows are linked by their own contents (two 64-bit hashes of all columns beside the key), not by key alone: different
    texts under one key, or without a key, each stay unless they are linked. A null key is the greatest. Rows without words (null, empty and blank texts) are one for each key; each
    stays where that is null. An empty table gives an empty one. The rows are read from ``docs`` when they are needed, so
    they aren't written here; a small table of those that stay is.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    name = F.struct(F.col(f"`{key}`").isNull().alias("no_key"), F.col(f"`{key}`").alias("key"), F.xxhash64(*names).alias("h1"), F.xxhash64(F.lit("second"), *names).alias("h2"))
    linked = join(docs.select(name.alias("its"), F.col(f"`{text}`").alias("body")), k, percent, "its", "body")
    rows = linked.groupBy("its", "n_shingles", "component_id").agg(F.count(F.lit(1)).alias("copies"))
    blank, nameless = F.col("n_shingles") == 0, F.col("its.no_key")
    stays = rows.where(~blank & (F.col("its") == F.col("component_id")) | blank & nameless).select("its", F.when(blank, 1).otherwise(F.col("copies")).alias("copies"))
    least = rows.where(blank & ~nameless).groupBy(F.col("its.key").alias("k")).agg(F.min_by("copies", "its").alias("copies"), F.min("its").alias("its")).select("its", "copies")
    stays = stable(stays.union(least), "stays")
    discard(linked)
    small = stays.groupBy().agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("copies") > 1).cast("int")), F.lit(0)).alias("twice")).first()
    free = "its" + "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    kept = lambda which, n: docs.withColumn(free, name).join(bounded(stays.where(which).select(F.col("its").alias(free)), n, 64), free, "left_semi").select(*names)
    out = kept("copies = 1", small.n - small.twice)
    if small.twice:
        out = out.union(kept("copies > 1", small.twice).dropDuplicates())
    return out


#: All links and components in SQL.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS g FROM w),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN s sa ON sa.doc_id = p.a JOIN s sb ON sb.doc_id = p.b WHERE 100 * n >= 85 * (len(sa.g) + len(sb.g) - n)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = s.doc_id), doc_id)) AS component_id FROM s
"""
