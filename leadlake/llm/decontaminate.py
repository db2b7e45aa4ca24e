"""Benchmark decontamination: windows near a benchmark item in edit distance, by random-walk embedding and bit sampling.

Texts and items are compared in normal form (lower case, runs of letters and digits, single blanks).

* Windows: a text is looked at in windows of an item's own size. An item within ``d`` edits of a stretch of text shares
  one of any d + 1 disjoint parts of it exactly, so windows are laid where such a part occurs; that loses none.
* Grams: within d edits at most 4 d of a stretch's 4-grams are not those of the item, and a window begins and ends at most d
  characters beside the stretch. Windows that only share a part by chance are told by bit maps of their 4-grams, and then
  by counting grams in about the same place, before anything is embedded; chance meetings in a table before they are
  verified. A window laid by an item that is held passes both.
* Segments: the share of places at which embedded strings differ grows with their length, so longer items are looked up by
  disjoint segments. One of them has no more than its share of the edits, so its windows are laid and it is found as a
  short item is; what counts is the distance of the whole item.
* Embedding: a window is read by a walk over random bits; at each step the current character is written and the walk
  moves on or stays by a bit drawn for (step, character). Texts within k edits get strings within about k^2 places.
* Bit sampling: each of several tables takes a few places of the embedded string as key. A window that meets an item
  in any table is a candidate. ``tables_needed`` derives their number from the wished recall.
* Verification: candidates are confirmed by their exact edit distance to the best stretch at the window.

The benchmark is the query set: it is read in blocks of bounded size, each block against all documents, one pass each,
without a shuffle of documents.

Defined results: NULL or empty texts hold nothing, NULL or empty items are held by nothing; items too short to be evidence
(``MIN_CHARS``) count only where they are the whole text; repeated items and repeated rows are reported each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Edits allowed per hundred characters of an item.
EDIT_PERCENT = 8
MIN_CHARS = 25
BLOCK_BYTES = 8 << 20
#: Longer items are looked up by segments of at most this size; windows that are embedded at once.
SEGMENT_CHARS = 200
WINDOWS = 4096
WALKS = 8
SAMPLED = 4
#: Length of a gram, bits of a map of grams, and pairs of windows and segments that are compared at once.
GRAM = 4
BITS = 1024
PAIRS = 1 << 18
#: Share of places of the embedded string that may differ at the largest allowed distance, and the wished recall there.
DIFFERENT = 0.5
RECALL = 0.999

_RUN = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(_RUN.findall(text.lower())) if text else ""


def tables_needed(recall: float = RECALL, different: float = DIFFERENT, sampled: int = SAMPLED) -> int:
    """Tables until a pair that differs in this share of places meets in one of them with the wished probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - different) ** sampled))


class Embedding:
    """The random walks; the same for items and texts. Characters are told apart by their code modulo 256."""

    def __init__(self, longest: int, seed: int = 20240607):
        rng = np.random.default_rng(seed)
        self.steps = 3 * longest
        self.bits = rng.integers(0, 2, (WALKS, self.steps, 256), dtype=np.int8)
        per_walk = -(-tables_needed() // WALKS)
        self.places = rng.random((WALKS, per_walk, SAMPLED))

    def keys(self, texts: list[str], sizes: list[int]) -> np.ndarray:
        """A hash of each text's key in each table, read as a window of the given size: one row per text."""
        out = np.empty((len(texts), self.places.shape[0] * self.places.shape[1]), np.uint64)
        order = np.argsort(sizes, kind="stable")
        for part in range(0, len(order), WINDOWS):
            some = order[part:part + WINDOWS]
            out[some] = self._keys([texts[i] for i in some], np.asarray([sizes[i] for i in some], np.int64))
        return out

    def _keys(self, texts: list[str], size: np.ndarray) -> np.ndarray:
        width = int(size.max())
        codes = np.zeros((len(texts), width + 1), np.uint32)
        for i, (t, n) in enumerate(zip(texts, size.tolist())):
            got = np.frombuffer(t[:n].encode("utf-32-le", "surrogatepass"), "<u4")
            codes[i, :len(got)] = got
        rows = np.arange(len(texts))
        found = []
        for walk in range(WALKS):
            at = np.zeros(len(texts), np.int64)
            wrote = np.zeros((len(texts), 2 * width), np.uint32)
            for step in range(2 * width):
                char = codes[rows, np.minimum(at, size)]
                wrote[:, step] = char
                at += self.bits[walk, step][char & 255]
            # A walk passes a character in two steps on average: places lie in the first two window lengths.
            for share in self.places[walk]:
                spots = (share[None, :] * (2 * size)[:, None]).astype(np.int64)
                taken = wrote[rows[:, None], spots]
                key = (size * 65536 + len(found)).astype(np.uint64)
                for column in taken.T:
                    key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                found.append(key)
        return np.stack(found, axis=1)


def best_stretch(item: str, text: str) -> tuple[int, int]:
    """(edits, end): the stretch of ``text`` nearest to ``item``, by bit-parallel dynamic programming over columns."""
    size = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for j, c in enumerate(text):
        hit = masks.get(c, 0)
        same = hit | down
        carry = (((hit & up) + up) ^ up) | hit
        plus = down | (full & ~(carry | up))
        minus = up & carry
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full  # a stretch may begin anywhere: no edit for what precedes
        up = minus | (full & ~(same | plus))
        down = plus & same
        if score < best:
            best, end = score, j + 1
    return best, end


def gram_codes(text: str) -> np.ndarray:
    """A hash of the gram at every position of a text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = max(len(codes) - GRAM + 1, 0)
    hashed = np.zeros(size, np.uint64)
    for i in range(GRAM):
        hashed = (hashed ^ codes[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return (hashed >> np.uint64(24)).astype(np.int64)


def gram_maps(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bit maps of the grams of windows of one text, 64 bits a word."""
    count = np.maximum(np.minimum(start + size, len(codes) + GRAM - 1) - start - GRAM + 1, 0)
    rows = np.repeat(np.arange(len(start)), count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    marks = np.zeros((len(start), BITS), np.uint8)
    marks[rows, codes[np.repeat(start, count) + inner] % BITS] = 1
    return np.packbits(marks, axis=1).view(np.uint64)


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = [(i, n) for i, n in ((i, normal(t)) for i, t in items) if n]
        self.whole = defaultdict(list)
        self.long = []
        for item, text in self.items:
            if len(text) < MIN_CHARS:
                self.whole[text].append(item)
            else:
                self.long.append((item, text, len(text) * EDIT_PERCENT // 100))
        self.seeds = None
        if not self.long:
            return
        self.segments = []  # (number of the item, offset in it, text)
        for n, (_, text, _) in enumerate(self.long):
            count = -(-len(text) // SEGMENT_CHARS)
            cuts = [len(text) * k // count for k in range(count + 1)]
            self.segments.extend((n, a, text[a:b]) for a, b in zip(cuts, cuts[1:]))
        sizes = [len(t) for _, _, t in self.segments]
        self.embedding = Embedding(max(sizes))
        keys = self.embedding.keys([t for _, _, t in self.segments], sizes)
        order = np.argsort(keys, axis=None)
        self.keys, self.owners = keys.ravel()[order], order // keys.shape[1]
        self.sizes = np.array(sizes)
        edits = self.sizes * EDIT_PERCENT // 100
        self.spare = (GRAM + 1) * edits + 2 * (GRAM - 1)
        self.maps = np.concatenate([gram_maps(gram_codes(t), np.zeros(1, np.int64), np.array([len(t)])) for _, _, t in self.segments])
        # Grams of the segments, one in a row, with a margin on either side that equals nothing.
        self.margin = int(edits.max())
        self.grams = np.full((len(sizes), max(sizes) + 2 * self.margin), -1, np.int64)
        for n, (_, _, text) in enumerate(self.segments):
            codes = gram_codes(text)
            self.grams[n, self.margin:self.margin + len(codes)] = codes
        parts: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for segment, (_, _, text) in enumerate(self.segments):
            cuts = [len(text) * k // (int(edits[segment]) + 1) for k in range(int(edits[segment]) + 2)]
            for a, b in zip(cuts, cuts[1:]):
                parts[text[a:b]].append((a, segment))
        self.seeds = ahocorasick.Automaton()
        for part, where in parts.items():
            offsets, owners = zip(*where)
            self.seeds.add_word(part, (np.array(offsets) + len(part), np.array(owners)))
        self.seeds.make_automaton()

    def windows(self, text: str) -> set[tuple[int, int]]:
        """(start, size) of the windows that share a part with a segment and hold enough of its grams."""
        found: set[tuple[int, int]] = set()
        codes, starts, owners, held = gram_codes(text), [], [], 0

        def compare() -> None:
            pairs = np.unique(np.maximum(0, np.concatenate(starts)) * len(self.segments) + np.concatenate(owners))
            start, owner = np.divmod(pairs, len(self.segments))
            near = self._near(codes, start, owner)
            found.update(zip(start[near].tolist(), self.sizes[owner[near]].tolist()))

        for end, (offsets, segments) in self.seeds.iter(text):
            starts.append(end + 1 - offsets)
            owners.append(segments)
            held += len(segments)
            if held >= PAIRS:
                compare()
                starts, owners, held = [], [], 0
        if held:
            compare()
        return found

    def _near(self, codes: np.ndarray, start: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether the window at ``start`` lacks no more grams of its segment than the allowed edits explain."""
        size = self.sizes[owner]
        alike, which = np.unique(start * (SEGMENT_CHARS + 1) + size, return_inverse=True)
        order = np.argsort(which, kind="stable")
        near = np.zeros(len(start), bool)
        for at in range(0, len(order), WINDOWS):
            here = order[at:at + WINDOWS]
            low, high = which[here[0]], which[here[-1]] + 1
            some = alike[low:high]
            maps = gram_maps(codes, some // (SEGMENT_CHARS + 1), some % (SEGMENT_CHARS + 1))
            foreign = np.bitwise_count(maps[which[here] - low] & ~self.maps[owner[here]]).sum(axis=1)
            here = here[foreign <= self.spare[owner[here]]]
            near[here] = self._in_place(codes, start[here], owner[here])
        return near

    def _in_place(self, codes: np.ndarray, start: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The same, of grams that the segment has within the allowed edits of the same place."""
        near = np.zeros(len(start), bool)
        for at in range(0, len(start), 512):
            first, own = start[at:at + 512], owner[at:at + 512]
            grams = self.sizes[own] - GRAM + 1
            column = np.arange(int(grams.max()))
            spot = first[:, None] + column
            inside = (column < grams[:, None]) & (spot < len(codes))
            mine = np.where(inside, codes[np.minimum(spot, len(codes) - 1)], -2)
            theirs, matched = self.grams[own], np.zeros(mine.shape, bool)
            for shift in range(2 * self.margin + 1):
                matched |= mine == theirs[:, shift:shift + mine.shape[1]]
            near[at:at + 512] = inside.sum(axis=1) - matched.sum(axis=1) <= self.spare[own]
        return near

    def _met(self, texts: list[str], sizes: list[int]) -> list[tuple[int, int]]:
        """(window, segment) that meet in any table."""
        keys = self.embedding.keys(texts, sizes)
        low, high = (np.searchsorted(self.keys, keys.ravel(), side) for side in ("left", "right"))
        hit = np.flatnonzero(high > low)
        count = high[hit] - low[hit]
        at = np.repeat(low[hit] - np.cumsum(count) + count, count) + np.arange(count.sum())
        both = np.unique(np.repeat(hit // keys.shape[1], count) * len(self.segments) + self.owners[at])
        return list(zip((both // len(self.segments)).tolist(), (both % len(self.segments)).tolist()))

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text the (item_id, edits, start, end) it holds, one per item, in characters of the normal form."""
        plain = [normal(t) for t in texts]
        out: list[list] = [[(i, 0, 0, len(t)) for i in self.whole.get(t, ())] if t else [] for t in plain]
        if self.seeds is None:
            return out
        spots = [(n, start, size) for n, t in enumerate(plain) if t for start, size in self.windows(t)]
        pairs: dict[tuple[int, int], set[int]] = defaultdict(set)
        for part in range(0, len(spots), WINDOWS):
            some = spots[part:part + WINDOWS]
            met: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for window, segment in self._met([plain[n][s:s + z] for n, s, z in some], [z for _, _, z in some]):
                met[some[window][0]].append((some[window][1], segment))
            for n, both in met.items():
                start, owner = np.array(both).T
                near = self._near(gram_codes(plain[n]), start, owner)
                for at, segment in zip(start[near].tolist(), owner[near].tolist()):
                    item, offset, _ = self.segments[segment]
                    pairs[(n, item)].add(max(0, at - offset))
        for (n, item), starts in pairs.items():
            item_id, text, edits = self.long[item]
            ordered = sorted(starts)
            while ordered:
                last = 1
                while last < len(ordered) and ordered[last] - ordered[last - 1] <= edits:
                    last += 1
                low = max(0, ordered[0] - edits)
                got, end = best_stretch(text, plain[n][low:ordered[last - 1] + len(text) + 2 * edits])
                if got <= edits:
                    out[n].append((item_id, got, max(low, low + end - len(text)), low + end))
                    if got == 0:
                        break
                ordered = ordered[last:]
        return [sorted({h[0]: h for h in sorted(hits, key=lambda h: -h[1])}.values()) for hits in out]


_CACHE: dict[str, Searcher] = {}


def _digest(block: list[tuple[int, str]]) -> str:
    """Tells a block by its content; addresses of broadcasts are used again by later ones."""
    return hashlib.sha256(repr(block).encode()).hexdigest()


def _searcher(items, digest: str) -> Searcher:
    """The searcher of a broadcast block, once per worker."""
    if digest not in _CACHE:
        _CACHE.clear()
        _CACHE[digest] = Searcher(items.value)
    return _CACHE[digest]


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about ``block_bytes``: only one part at a time is held by the driver."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t")).filter(F.length("t") > 0)
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [(r["i"], r["t"]) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item, edits, start, end): every benchmark item that a document holds within the allowed edits."""
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField(item, benchmark.schema[item].dataType),
        T.StructField("edits", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    result = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item, item_text, block_bytes):
        items = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pd.DataFrame], items=items, digest=_digest(block)) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = _searcher(items, digest).find(batch["_text"].tolist())
                hits = [(k, *h) for k, each in zip(batch["_key"], found) for h in each]
                yield pd.DataFrame(hits, columns=schema.names)

        source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
        result = result.union(source.mapInPandas(search, schema))
    return result


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose text holds no benchmark item."""
    spark, kept = docs.sparkSession, docs
    for block in _blocks(benchmark, item, item_text, block_bytes):
        items = spark.sparkContext.broadcast(block)

        kept = kept.filter(F.pandas_udf(_clean_with(items), "boolean")(F.col(text).cast("string")))
    return kept


def _clean_with(items):
    digest = _digest(items.value)

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([not found for found in _searcher(items, digest).find(batch.tolist())], dtype=bool)

    return clean
