"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import small_batches

_WORD = re.compile(r"[^\W_]+")


def features(word: str) -> tuple[str, ...]:
    """What the field knows of a word in lower case: itself, how it begins and how it ends."""
    return (f"w={word}", f"4={word[:4]}", f"5={word[:5]}", f"6={word[:6]}", f"e={word[-4:]}")


def lines_of(text: str) -> list[list[str]]:
    """The chains of a text: the words of each of its lines, in lower case. Words are found before they are lowered where
    that changes lengths, so that every word has its place in the text."""
    low = text.lower()
    if len(low) == len(text):
        return [w for line in low.split("\n") if (w := _WORD.findall(line))]
    return [[x.lower() for x in w] for line in text.split("\n") if (w := _WORD.findall(line))]


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label 1, sums of pair marginals, and log-likelihood constants of chains held row by row.

    ``scores``: (chains, longest) advantage of label 1 over 0 at each place; ``trans``: (2, 2) weights of label pairs.
    Chains come longest first, so that at every place those that still run are the first rows.
    """
    n, longest = scores.shape
    (e00, e01), (e10, e11) = np.exp(trans)
    psi = np.exp(np.clip(scores, -30, 30)).T.copy()
    one, zero, scale = np.empty((longest, n)), np.empty((longest, n)), np.ones((longest, n))
    running = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for t in range(longest):
        k = running[t]
        if t:
            x0, x1 = zero[t - 1, :k], one[t - 1, :k]
            c0, c1 = x0 * e00 + x1 * e10, (x0 * e01 + x1 * e11) * psi[t, :k]
        else:
            c0, c1 = np.ones(k), psi[0, :k]
        s = c0 + c1
        scale[t, :k], zero[t, :k], one[t, :k] = s, c0 / s, c1 / s
    marginal = np.zeros((longest, n))
    pairs = np.zeros((2, 2))
    b0, b1 = np.ones(n), np.ones(n)
    for t in range(longest - 1, -1, -1):
        k = running[t]
        y0, y1 = zero[t, :k] * b0[:k], one[t, :k] * b1[:k]
        marginal[t, :k] = y1 / (y0 + y1)
        if t:
            o0, o1 = b0[:k] / scale[t, :k], b1[:k] / scale[t, :k] * psi[t, :k]
            x0, x1 = zero[t - 1, :k], one[t - 1, :k]
            pairs += [[(x0 * o0).sum() * e00, (x0 * o1).sum() * e01], [(x1 * o0).sum() * e10, (x1 * o1).sum() * e11]]
            b0[:k], b1[:k] = o0 * e00 + o1 * e01, o0 * e10 + o1 * e11
    return marginal.T, pairs, float(np.log(scale).sum())


@dataclass
class Field:
    """Weights of features for label 1, of label pairs, and of the document scores."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    doc: np.ndarray | None = None
    rate: float = 0.0

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def advantage(self, words: list[str]) -> list[float]:
        known = self.known
        got = list(map(known.get, words))
        if None in got:
            if len(known) > 500_000:
                known.clear()
                got = [None] * len(words)
            w = self.weights
            for x in {x for x, y in zip(words, got, strict=True) if y is None}:
                known[x] = self.bias + sum([w.get(f, 0.0) for f in features(x)])
            got = list(map(known.get, words))
        return got

    def marginals(self, chains: list[list[str]], most: int = 2_000_000) -> list[np.ndarray]:
        """Marginal of label 1 at each word of each chain, in groups of chains of like length and bounded size."""
        out: list[np.ndarray] = [np.empty(0)] * len(chains)
        order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
        i = 0
        while i < len(order):
            longest = len(chains[order[i]])
            if not longest:
                break
            some = []
            while i < len(order) and (len(some) + 1) * longest <= max(most, longest) and 2 * len(chains[order[i]]) >= longest:
                some.append(order[i])
                i += 1
            if not some:
                break
            lengths = np.asarray([len(chains[j]) for j in some])
            scores = np.zeros((len(some), longest))
            for r, j in enumerate(some):
                scores[r, : lengths[r]] = self.advantage(chains[j])
            m = forward_backward(scores, lengths, self.trans)[0]
            for r, j in enumerate(some):
                out[j] = m[r, : lengths[r]]
        return out

    def document(self, marginals: list[np.ndarray]) -> np.ndarray:
        """What the document score is made of: the surest word, the expected number of toxic words, and its share."""
        p = np.concatenate(marginals) if marginals else np.empty(0)
        if not len(p):
            return np.zeros(4)
        top = np.sort(p)[::-1][:2]
        return np.asarray([top[0], top[1] if len(top) > 1 else 0.0, np.log1p(p.sum()), p.sum() / len(p)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.doc is None:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(x @ self.doc[1:] + self.doc[0], -30, 30)))


def mark(texts: list[str], toxic: list[int], least: int = 4, odds: float = 3.0) -> list[list[np.ndarray]]:
    """Token labels from document labels: in toxic documents, words of which toxic documents have ``odds`` (natural log)
    times more than others, by the word itself or how it begins; none elsewhere."""
    count = (Counter(), Counter())
    n = [max(1, sum(1 for y in toxic if y == c)) for c in (0, 1)]
    chains = [lines_of(t) for t in texts]
    for c, y in zip(chains, toxic, strict=True):
        count[y].update({f for w in {w for line in c for w in line} for f in features(w)[:4]})
    strong = {f for f, k in count[1].items() if k >= least and np.log((k + 0.5) / n[1]) - np.log((count[0][f] + 0.5) / n[0]) > odds}
    is_strong: dict[str, bool] = {}

    def hit(w: str) -> bool:
        if w not in is_strong:
            is_strong[w] = any(f in strong for f in features(w)[:4])
        return is_strong[w]

    return [[np.asarray([y == 1 and hit(w) for w in line]) for line in c] for c, y in zip(chains, toxic, strict=True)]


def fit(texts: list[str], toxic: list[int], rounds: int = 25, rate: float = 0.5, decay: float = 1e-5) -> Field:
    """Train the field on the labelled words of a sample and then the document score on the field's own marginals."""
    toxic = [int(y) for y in toxic]
    out = Field(rate=float(np.mean(toxic)) if toxic else 0.0)
    if len(set(toxic)) < 2:
        return out
    chains, labels = [], []
    for t, ys in zip(texts, mark(texts, toxic), strict=True):
        for line, y in zip(lines_of(t), ys, strict=True):
            chains.append(line)
            labels.append(y)
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    seen: Counter[str] = Counter()
    for c in chains:
        seen.update(c)
    ids: dict[str, int] = {}
    number = {w: i for i, w in enumerate(seen)}
    table = np.asarray([[ids.setdefault(f, len(ids)) for f in features(w)] for w in seen])  # a row for each word
    theta, trans = np.zeros(len(ids) + 1), np.zeros((2, 2))
    theta[-1] = -3.0
    groups = []
    i = 0
    while i < len(order):
        longest = len(chains[order[i]])
        some = []
        while i < len(order) and (len(some) + 1) * longest <= 400_000 and 2 * len(chains[order[i]]) >= longest:
            some.append(order[i])
            i += 1
        if not some:
            some, i = [order[i]], i + 1
        lengths = np.asarray([len(chains[j]) for j in some])
        f = np.full((len(some), longest), len(seen), np.int32)
        y = np.zeros((len(some), longest))
        for r, j in enumerate(some):
            f[r, : lengths[r]] = [number[w] for w in chains[j]]
            y[r, : lengths[r]] = labels[j]
        groups.append((lengths, f, y, np.arange(longest)[None] < lengths[:, None]))
    g2, t2 = np.full(len(theta), 1e-3), np.full((2, 2), 1e-3)
    total = sum(len(c) for c in chains)
    for _ in range(rounds):
        grad, tgrad = -decay * theta * total, np.zeros((2, 2))
        w = np.append(theta[table].sum(axis=1) + theta[-1], 0.0)
        by_word = np.zeros(len(w))
        for lengths, f, y, there in groups:
            m, pairs, _ = forward_backward(w[f], lengths, trans)
            diff = np.where(there, y - m, 0.0)
            by_word += np.bincount(f.ravel(), diff.ravel(), len(w))
            a, b, both = y[:, :-1], y[:, 1:], there[:, 1:]
            seen_pairs = np.asarray([[((1 - a) * (1 - b) * both).sum(), ((1 - a) * b * both).sum()], [(a * (1 - b) * both).sum(), (a * b * both).sum()]])
            tgrad += seen_pairs - pairs
        grad += np.bincount(table.ravel(), np.repeat(by_word[:-1], table.shape[1]), len(theta))
        grad[-1] += by_word[:-1].sum()
        g2 += grad * grad
        t2 += tgrad * tgrad
        theta += rate * grad / np.sqrt(g2)
        trans += rate * tgrad / np.sqrt(t2)
    out.weights = {f: float(theta[i]) for f, i in ids.items() if abs(theta[i]) > 1e-3}
    out.bias, out.trans = float(theta[-1]), trans
    per, at = [], 0
    flat = out.marginals(chains)
    for n in (len(lines_of(t)) for t in texts):
        per.append(out.document(flat[at : at + n]))
        at += n
    out.doc = _logistic(np.stack(per), np.asarray(toxic, float))
    out.known = {}
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Weights, the constant first, by Newton's steps."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def spans_of(model: Field, text: str, marginals: list[np.ndarray], least: float = 0.5) -> list[tuple[int, int, float]]:
    """Stretches of words next to each other with a marginal of ``least`` or more: start, end, greatest marginal."""
    out, at, k = [], 0, 0
    for line in text.split("\n"):
        words = [m.span() for m in _WORD.finditer(line)]
        if words:
            p, last = marginals[k], None
            k += 1
            for i in np.flatnonzero(p >= least):
                s, e = words[i]
                if last == i - 1:
                    out[-1] = (out[-1][0], at + e, max(out[-1][2], float(p[i])))
                else:
                    out.append((at + s, at + e, float(p[i])))
                last = i
        at += len(line) + 1
    return out


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_docs: int = 1000, sample_chars: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """Toxicity of every whole text: ``key, held_out, score, predicted, spans``.

    The field learns from labelled rows whose crc32(key as text) mod 3 isn't 1 (those are ``held_out``): the first
    ``sample_docs`` of either label by a hash of the key, a text of at most ``sample_chars`` characters each; that is all the
    driver gets, and the model, a few MB, all that is broadcast. Scoring covers every text in full and has no shuffle.
    Spans are the offending character offsets with the greatest marginal in each.

    Null and empty texts get the score of a text without toxic words; null labels aren't learned from, of several for a
    key the greatest counts, and without both labels every score is the sample's rate. Repeated rows come out one by
    one, other columns are left out, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out_of = lambda k: F.crc32(F.coalesce(k.cast("string"), F.lit(""))) % 3 == 1
    given = labels.where(F.col(label).isNotNull()).groupBy(F.col(f"`{key}`").alias("its")).agg(F.max(F.col(label).cast("int")).alias("y")).where(~out_of(F.col("its")))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    order = F.xxhash64(F.col("its").cast("string"), F.lit("sample"))
    chosen = None
    for y in (0, 1):
        some = given.where(F.col("y") == y).orderBy(order, "its").limit(sample_docs)
        chosen = some if chosen is None else chosen.union(some)
    sample = rows.where(F.length("body") <= sample_chars).join(F.broadcast(chosen), F.col("key") == F.col("its"))
    sample = sample.groupBy("key").agg(F.min("body").alias("body"), F.first("y").alias("y")).toPandas()  # a row a key
    sample = sample.sort_values(["key", "body"], ignore_index=True)
    model = fit(sample.body.tolist(), sample.y.tolist())
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            chains = [lines_of(t) for t in texts]
            flat = m.marginals([line for c in chains for line in c])
            x, spans, at = np.zeros((len(texts), 4)), [], 0
            for i, (t, c) in enumerate(zip(texts, chains, strict=True)):
                own = flat[at : at + len(c)]
                at += len(c)
                x[i] = m.document(own)
                spans.append([{"start": s, "end": e, "p": p} for s, e, p in spans_of(m, t, own)] if x[i, 0] >= 0.5 else [])
            got = m.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))], ["key", "score", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    got = rows.mapInArrow(run, f"key {kind}, score double, spans array<struct<start:int,end:int,p:double>>")
    return got.select(F.col("key").alias(key), out_of(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
