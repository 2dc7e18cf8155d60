"""Token counts of texts of any length, and the token ids of whole texts.

Texts are encoded in overlapping chunks with offsets, and neighbouring chunks are spliced where both agree. The units of a
chunk are the library's tokens; for a tokenizer that drops white space they are the words between it, whose ids don't
depend on each other. Chunks of many texts are split into words and spliced together, and each different word of them is
encoded once. Ids of many whole texts take one lookup for each different part of a word.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import small_batches

#: Fixed value: the split pattern of a word tokenizer that drops white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters of which lower-casing and composition are the same in every library: ASCII and the letters of Latin-1.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_SPACE = re.compile(r"[\t-\r ]")
_WORD = re.compile(r"[^\t-\r ]+")
#: Characters of a word that the cache may hold, so that it is bounded in bytes too.
MOST_CACHED = 64


class Encoder:
    """Token ids as the library gives them, without added special tokens."""

    def __init__(self, path: str, max_parts: int = 400_000):
        self.path, self.max_parts = path, max_parts
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece

            self.tok = sentencepiece.SentencePieceProcessor(model_file=path)
            self.drops_space = False
            return
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, self.added)) or "(?!)")
        self.drops_space = _drops_space(spec)
        if self.drops_space:
            vocab = self.tok.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[list[int]]:
        if self.pieces:
            return self.tok.encode(texts, num_threads=1)
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids with the half-open range of characters that each stands for."""
        if self.pieces:
            out = self.tok.encode(text, return_type="proto")
            begins = np.cumsum([0, *[len(c.encode()) for c in text]])  # its offsets count bytes
            spans = np.searchsorted(begins, [(p.begin, p.end) for p in out.pieces]).tolist() if out.pieces else []
            return [p.id for p in out.pieces], [tuple(x) for x in spans]
        e = self.tok.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    def units(self, text: str, a: int, b: int) -> tuple[list[int], list[bytes]]:
        """Where the units of ``text[a:b]`` start in the text, and the ids of each: words, or tokens of the library."""
        part = text[a:b]
        if not self.drops_space:
            ids, spans = self.with_offsets(part)
            raw = np.asarray(ids, "<u4").tobytes()
            return [a + s for s, _ in spans], [raw[i : i + 4] for i in range(0, len(raw), 4)]
        words = _WORD.findall(part)
        known = self.words
        got = list(map(known.get, words))
        if None in got:
            if len(known) > self.max_parts:
                known.clear()
            got = self._words(words)
        return [a + m.start() for m in _WORD.finditer(part)], got

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words, those not met before learned at once."""
        known = self.words
        new = [w for w in dict.fromkeys(words) if w not in known]
        plain = [w for w in new if _PLAIN.fullmatch(w) and not self.special.search(w)]
        self._plain(" ".join(plain))
        fresh = {w: self._plain(w) for w in plain}
        odd = [w for w in new if w not in fresh]
        fresh.update(zip(odd, (np.asarray(x, "<u4").tobytes() for x in (self.library(odd) if odd else [])), strict=True))
        known.update((w, x) for w, x in fresh.items() if len(w) <= MOST_CACHED)
        return [fresh[w] if w in fresh else known[w] for w in words]

    def ids(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit integers."""
        if not self.drops_space:
            return np.asarray(self.library([text])[0], "<u4").tobytes()
        if _PLAIN.fullmatch(text) and not self.special.search(text):
            return self._plain(text)
        out, plain = [], []
        for w in text.translate(_TO_SPACE).split(" "):
            if _PLAIN.fullmatch(w) and not self.special.search(w):
                plain.append(w)
                continue
            out.append(self._plain(" ".join(plain)))
            plain = []
            if w not in self.odd:
                if len(self.odd) >= self.max_parts // 4:
                    self.odd = {}
                self.odd[w] = np.asarray(self.library([w])[0], "<u4").tobytes()
            out.append(self.odd[w])
        return b"".join([*out, self._plain(" ".join(plain))])

    def many_ids(self, texts: pa.Array, size: int = 4 << 20) -> Iterator[bytes]:
        """As all_ids() of each text of an Arrow array, in order; null is empty.

        For a tokenizer that drops white space, neighbouring texts of ``size`` bytes in all are split at once, and each
        different part of them is looked up once. A longer text is taken alone, as is one that isn't plain.
        """
        texts = pc.fill_null(texts, "")
        if not self.drops_space:
            for t in texts:
                yield self.all_ids(t.as_py())
            return
        ends = pc.binary_length(texts).to_numpy().astype("i8").cumsum()
        at = before = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            if ends[end - 1] - before > size:
                yield self.all_ids(texts[at].as_py())
            else:
                yield from self._together(texts.slice(at, end - at).cast(pa.string()))
            at, before = end, ends[end - 1]

    def _together(self, texts: pa.StringArray) -> Iterator[bytes]:
        kinds, begins = _bytes(texts)
        bad = np.zeros(len(texts), bool)
        bad[np.searchsorted(begins, np.flatnonzero(kinds == _OTHER_BYTE), side="right") - 1] = True
        for t in self.added:
            bad |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        odd = {i: texts[i].as_py() for i in np.flatnonzero(bad).tolist()}
        if odd:
            texts = pc.if_else(pa.array(bad), "", texts)
            kinds, begins = _bytes(texts)
        parts, first = _parts(texts, kinds, begins)
        each = parts.dictionary_encode()
        ids = pa.array(self._found(each.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(each.indices)
        _, cuts, raw = ids.buffers()
        cuts = np.frombuffer(cuts, "<i8")[first].tolist() if len(ids) else [0] * len(first)
        raw = memoryview(raw or b"")
        for k, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)):
            yield self.ids(odd[k]) if k in odd else raw[i:j].tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(self._found(_PARTS.findall(text.lower())))

    def _found(self, parts: list[str]) -> list[bytes]:
        found = list(map(self.parts.get, parts))
        if None in found:
            new = {x for x, y in zip(parts, found, strict=True) if y is None}
            if len(self.parts) + len(new) > self.max_parts:
                self.older, self.parts, new = self.parts, {}, set(parts)
            self._learn(new)
            found = [self.parts[x] if y is None else y for x, y in zip(parts, found, strict=True)]
        return found

    def _learn(self, new: set[str]) -> None:
        """Each part is one unit of the tokenizer's merges, and only the last of its tokens ends a word."""
        known = new & self.older.keys()
        self.parts.update((x, self.older[x]) for x in known)
        todo = list(new - known)
        for k in range(0, len(todo), 1000):
            some = todo[k : k + 1000]
            ids = np.asarray(self.library([" ".join(some)])[0], "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(cuts) == len(some) and cuts[-1] == len(raw):
                self.parts.update(zip(some, (raw[i:j] for i, j in zip([0, *cuts], cuts, strict=False)), strict=True))
            else:
                self.parts.update((x, np.asarray(y, "<u4").tobytes()) for x, y in zip(some, self.library(some), strict=True))

    def all_ids(self, text: str, size: int = 4 << 20) -> bytes:
        """As ids(); a text of many MB is taken in stretches that end at white space, so that its words don't fill the memory."""
        if not self.drops_space or len(text) <= size:
            return self.ids(text)
        out, at = [], 0
        while at < len(text):
            m = _SPACE.search(text, at + size)
            end = m.start() if m else len(text)
            out.append(self.ids(text[at:end]))
            at = end
        return b"".join(out)


#: The ASCII white space characters.
_TO_SPACE = str.maketrans("\t\n\x0b\x0c\r", "     ")


#: Kinds of UTF-8 bytes: white space, digit, letter, mark, and those that no plain text has. The plain characters beyond ASCII
#: all begin with C3 and are letters, so each of their bytes tells this by itself.
_SPACE_BYTE, _DIGIT_BYTE, _LETTER_BYTE, _MARK_BYTE, _OTHER_BYTE = range(5)
_KINDS = bytes(
    _SPACE_BYTE if 9 <= b <= 13 or b == 32
    else _DIGIT_BYTE if 48 <= b <= 57
    else _LETTER_BYTE if 65 <= b <= 90 or 97 <= b <= 122 or b == 0xC3 or 0x80 <= b <= 0xBF and b not in (0x97, 0xB7)
    else _MARK_BYTE if 32 < b < 127
    else _OTHER_BYTE
    for b in range(256)
)
#: Lower case of the bytes of plain text: A to Z, and the second bytes of À to Þ.
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The kinds of all bytes of texts without null, and where each text begins among them; one more begin is the end."""
    begins = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(_raw(texts, begins).translate(_KINDS), "u1"), begins - begins[0]


def _raw(texts: pa.StringArray, begins: np.ndarray) -> bytes:
    data = texts.buffers()[2]
    return data.slice(int(begins[0]), int(begins[-1] - begins[0])).to_pybytes() if data else b""


def _parts(texts: pa.StringArray, kinds: np.ndarray, begins: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """All matches of _PARTS in plain texts in lower case, and the number of those before each text and in all."""
    n = len(kinds)
    offsets = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1]
    low = _raw(texts, offsets).translate(_LOWER)
    raw = np.frombuffer(low, "u1")
    new = np.ones(n + 1, bool)  # where a part, or white space, begins
    if n:
        np.not_equal(kinds[1:], kinds[:-1], out=new[1:n])
        new[:n] |= kinds == _DIGIT_BYTE
        new[begins] = True
        # an apostrophe alone takes s, t, m, d, re, ve or ll with it
        at = np.flatnonzero(raw == 39)
        at = at[new[at] & new[at + 1]]
        text_end = begins[np.searchsorted(begins, at, side="right")]
        one, two = (np.where(at + k < text_end, raw[np.minimum(at + k, n - 1)], 0) for k in (1, 2))
        short = np.isin(one, np.frombuffer(b"stmd", "u1"))
        long = (two == 101) & ((one == 114) | (one == 118)) | (one == 108) & (two == 108)
        new[at[short | long] + 1] = False
        new[at[short] + 2] = True
        new[at[long] + 3] = True
    starts = np.flatnonzero(new).astype("<i4")
    runs = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(low))
    word = kinds[starts[:-1]] != _SPACE_BYTE
    before = np.concatenate([[0], np.cumsum(word)])
    return runs.filter(pa.array(word)), before[np.searchsorted(starts, begins)]


def _drops_space(spec: dict) -> bool:
    """Whether the tokenizer's own description shows that no token spans white space and that words don't affect each other."""
    norm = spec.get("normalizer") or {}
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    safe = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " " for n in norm.get("normalizers", [norm] if norm else []))
    split = bool(pre) and pre[0].get("type") == "Split" and pre[0].get("pattern") == {"Regex": WORD_PATTERN} and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True
    rest = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") for p in pre[1:])
    model = spec.get("model", {})
    own = model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
    added = all(not t["single_word"] and not t["normalized"] and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))
    return safe and split and rest and own and added


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, and so one cache, for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def spliced(enc: Encoder, text: str, chunk: int, overlap: int, run: int | None = None, stats: dict | None = None) -> list[bytes]:
    """Ids of a text, unit by unit, from overlapping chunks.

    Two neighbouring encodings are joined at a unit start where both have the same starts and ids for ``run`` units on
    either side (4 words, 8 tokens). For tokenizers that drop white space units are words, so that no token, merge or
    normalisation reaches across the start: the boundary is proven, not only observed. Tokens must start at white space or
    just after it, as a long run of one letter agrees with itself anywhere. If no such place lies in the
    overlap, the right chunk starts further left, with twice the overlap; in the end it starts where the left one did, and
    both are encoded as one chunk of at least twice the size.
    """
    n, begin, end = len(text), 0, min(chunk, len(text))  # begin: of the chunk in hand
    run = run or (4 if enc.drops_space else 8)
    starts, ids = enc.units(text, 0, end)
    out: list[bytes] = []
    while end < n:
        wide, new_end = overlap, min(n, end + max(1, chunk - overlap))
        while True:
            a = max(begin, end - wide)
            if a == begin:
                new_end = min(n, max(new_end, begin + 2 * (end - begin)))
                first, (starts, ids) = starts[0] if starts else begin, enc.units(text, begin, new_end)
                keep = bisect_left(starts, first)
                if keep and starts[keep : keep + 1] != [first]:  # never seen: what was settled doesn't hold, so begin anew
                    out, begin, keep = [], 0, 0
                    starts, ids = enc.units(text, 0, new_end)
                starts, ids = starts[keep:], ids[keep:]
                break
            r_starts, r_ids = enc.units(text, a, new_end)
            cut = _common(starts, ids, r_starts, r_ids, run, None if enc.drops_space else text)
            if stats is not None:
                stats["joined" if cut else "widened"] = stats.get("joined" if cut else "widened", 0) + 1
            if cut:
                i, j = cut
                out += ids[:i]
                starts, ids = r_starts[j:], r_ids[j:]
                begin = a
                break
            wide *= 2
        end = new_end
    return out + ids


def _common(ls: list[int], li: list[bytes], rs: list[int], ri: list[bytes], run: int, text: str | None) -> tuple[int, int] | None:
    """Numbers, left and right, of the middlemost unit start in the overlap around which both encodings agree; if ``text`` is
    given, of those at white space."""
    if not rs or not ls:
        return None
    at = {s: j for j, s in enumerate(rs[: 2 + bisect_right(rs, ls[-1])])}
    good, same, last = [], 0, -2
    for i in range(bisect_left(ls, rs[0]), len(ls)):
        j = at.get(ls[i], -1)
        same = 0 if j < 0 or li[i] != ri[j] else same + 1 if j == last + 1 else 1
        last = j
        if same >= 2 * run and (text is None or _SPACE.search(text, max(0, ls[i - run + 1] - 1), ls[i - run + 1] + 1)):
            good.append((i - run + 1, j - run + 1))
    return good[len(good) // 2] if good else None


#: Whether a byte is ASCII white space.
_IS_SPACE = bytes(9 <= b <= 13 or b == 32 for b in range(256))


def spliced_counts(enc: Encoder, texts: pa.Array, chunk: int, overlap: int, run: int = 4, size: int = 4 << 20) -> list[int]:
    """Number of ids that spliced() gives for each text of an Arrow array; null has none.

    For a tokenizer that drops white space, the chunks of neighbouring texts of ``size`` bytes in all are taken together. A
    longer text goes in stretches of whole chunks, each of which begins with the last chunk of the one before; that chunk is
    counted once. Texts of which two neighbouring chunks agree nowhere in their overlap are spliced one by one, with wider
    overlaps.
    """
    texts = pc.fill_null(texts, "")
    if not enc.drops_space or chunk < 2 * overlap:  # of wider overlaps one could reach into the next
        return [sum(map(len, spliced(enc, t, chunk, overlap))) // 4 for t in texts.to_pylist()]
    ends = pc.binary_length(texts).to_numpy().astype("i8").cumsum()
    out: list[int] = []
    at = before = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        if ends[end - 1] - before > size:
            text, step = texts[at].as_py(), chunk - overlap
            far = max(1, (size // 4 - chunk) // step) * step
            begins = range(0, max(1, len(text) - chunk), far)
            parts = [int(_spliced_together(enc, pa.array([text[i : i + far + chunk]]), chunk, overlap, run)[0]) for i in begins]
            twice = _spliced_together(enc, pa.array([text[i : i + chunk] for i in begins[1:]], pa.string()), chunk, overlap, run)
            got = [-1 if -1 in parts else sum(parts) - int(twice.sum())]
        else:
            got = _spliced_together(enc, texts.slice(at, end - at).cast(pa.string()), chunk, overlap, run).tolist()
        out += [sum(map(len, spliced(enc, texts[at + k].as_py(), chunk, overlap, run))) // 4 if n < 0 else n for k, n in enumerate(got)]
        at, before = end, ends[end - 1]
    return out


def _spliced_together(enc: Encoder, texts: pa.StringArray, chunk: int, overlap: int, run: int) -> np.ndarray:
    """Numbers of ids of texts without null from their chunks, spliced as in spliced(); -1 where an overlap is too narrow."""
    if not len(texts):
        return np.zeros(0, "i8")
    begins = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1]
    data, begins = _raw(texts, begins), begins - begins[0]
    # bytes [a, b) of each chunk, its text, and where it begins among all chunks
    chars = np.append(np.flatnonzero(np.frombuffer(data, "u1") & 0xC0 != 0x80), len(data))
    first = np.searchsorted(chars, begins)
    step = chunk - overlap
    each = 1 + np.maximum(0, -((chunk - np.diff(first)) // step))
    of = np.repeat(np.arange(len(texts)), each)
    a = first[of] + step * (np.arange(len(of)) - np.repeat(each.cumsum() - each, each))
    a, b = chars[a], chars[np.minimum(a + chunk, first[of + 1])]
    view = memoryview(data)
    cut = b"".join([view[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)])
    at = np.concatenate([[0], (b - a).cumsum()])
    # words of each chunk: those at its edges may be parts of words
    space = np.frombuffer(cut.translate(_IS_SPACE), bool)
    edge = np.zeros(len(cut) + 1, bool)
    edge[at] = True
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1] | edge[1:-1]
    ends[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    begin = np.searchsorted(starts, at)  # first word of each chunk
    left = np.flatnonzero(of[1:] == of[:-1])  # chunks that have a neighbour on the right
    right = left + 1
    # words in the overlaps, left and right
    li, lo = _ranges(np.searchsorted(starts, at[left] + a[right] - a[left]), begin[right])
    ri, ro = _ranges(begin[right], np.searchsorted(starts, at[right] + b[left] - a[right]))
    few = np.bincount(lo, minlength=len(left)) < 2 * run
    if few.any():  # these overlaps are too narrow whatever their words are
        bad = np.zeros(len(texts), bool)
        bad[of[left[few]]] = True
        return np.where(bad, -1, _spliced_together(enc, pc.if_else(pa.array(bad), "", texts), chunk, overlap, run))
    offsets = np.concatenate([[0], (ends - starts).cumsum()]).astype("<i4")
    letters = cut.translate(None, b"\t\n\x0b\x0c\r ")
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    ids = pa.array(list(enc.many_ids(words.dictionary)), pa.large_binary())
    code = words.indices.to_numpy()
    tokens = np.concatenate([[0], (pc.binary_length(ids).to_numpy() // 4)[code].cumsum()])  # before each word
    kind = ids.dictionary_encode().indices.to_numpy()[code]  # the same for the same ids
    out = np.add.reduceat(tokens[begin[1:]] - tokens[begin[:-1]], each.cumsum() - each).astype("i8")
    # where they start in the texts; overlaps don't touch, so all starts ascend
    ls, rs = starts[li] + (a - at[:-1])[left][lo], starts[ri] + (a - at[:-1])[right][ro]
    j = np.searchsorted(rs, ls)
    same = np.append(rs, -1)[j] == ls
    same[same] = kind[li[same]] == kind[ri[j[same]]]
    n = np.arange(len(li))
    since = n.copy()  # first word of the run of agreeing words
    since[1:][same[1:] & same[:-1] & (np.diff(j) == 1) & (np.diff(lo) == 0)] = 0
    good = np.flatnonzero(same & (n - np.maximum.accumulate(since) + 1 >= 2 * run))
    low, high = (np.searchsorted(lo[good], np.arange(len(left)), side=side) for side in ("left", "right"))
    found = high > low
    mid = good[((low + high) // 2)[found]]
    np.subtract.at(out, of[left[found]], tokens[ri[j[mid] - run + 1]] - tokens[li[mid - run + 1]])
    out[of[left[~found]]] = -1
    return out


def _ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of half-open ranges, one range after another, and the range of each."""
    n = ends - begins
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + (begins - n.cumsum() + n)[of], of


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, text: str = "text", key: str = "doc_id", chunk_chars: int = 2_048, overlap_chars: int = 192) -> DataFrame:
    """Tokens of every whole text: ``key, n_bytes, n_tokens, over_limit`` (more tokens than ``limit``).

    Null and empty texts count 0 bytes and 0 tokens; repeated rows are counted one by one; other columns, whatever their
    names, are left out; an empty table gives an empty one. Texts are encoded in overlapping chunks (spliced_counts), so
    beside a batch a task holds the words of about 4 MB of text at a time. There is no shuffle.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            size = pc.binary_length(pc.fill_null(b.column(1), "")).cast(pa.int64())
            n = spliced_counts(enc, b.column(1), chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    return rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", key)
