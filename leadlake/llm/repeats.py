"""Removal of long repeats: threshold-bounded interval expansion on Burrows-Wheeler transforms of anchored contexts.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else, in any document.

1. Anchors. In every window of ``LENGTH`` bytes the gram with the least hash is an anchor, so equal windows have equal
   anchors at equal places: two copies of a window always meet at an anchor. An anchor's context is what lies in the
   windows it is the anchor of, less than twice ``LENGTH`` bytes.
2. Classes. Places with equal anchor and context are one class. A class of two or more places is covered whole, whatever
   their number. Only anchors with different contexts, where a repeat begins or ends, need a closer look, and of each
   class one context.
3. Blocks. The contexts of an anchor come together in one block, many anchors to a block. The windows of a context are
   taken in ranges; hashes tell stretches that are equal as a whole, and those whose core no other context has. What is
   left of a block, the stretches in which a repeat begins or ends, is sorted and its
   Burrows-Wheeler transform taken. Intervals of equal prefixes are extended backwards, breadth first: the level at
   which a boundary between neighbouring suffixes first appears is their common prefix, so prefixes come out in
   increasing order, and the expansion stops at ``LENGTH``. Boundaries not seen by then are the repeats.
4. An anchor with very many different contexts (a passage placed in a great many documents) is cut by where a window lies
   around it: windows of a narrow range share a core, so the group falls apart by the hash of its core and its places are
   judged class by class again; ranges end at single windows, where a class is the answer. No group is large then.
5. What is covered is merged per document and cut out.

Documents are read in slices that overlap by a window, so one of any length needs bounded memory. Positions are bytes.

Defined results: NULL and empty texts have no bytes and no repeats; equal rows are each other's repeats, whole if long
enough; matches never cross documents; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.components import _written

LENGTH = 400
GRAM = 32
SLICE = 1 << 20
#: Contexts of one anchor that may share a block; more are cut by range, ``FAN`` ranges at a time.
MOST = 512
FAN = 8
#: Ranges by which contexts are compared by hash before they are transformed.
RANGES = 16
BLOCK_BYTES = 1 << 20
#: Symbols sorted at once. ``equal_windows`` packs three numbers of up to this many into 64 bits, so 2^21 would be too many.
RUN_SYMBOLS = 1 << 20
#: The expansion starts from the intervals of prefixes of this length, which the sort has already found.
START_LEVEL = 16
TEXT_SLOTS = 1 << 20

_RNG = np.random.default_rng(77)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.clear()
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every position on."""
    n = len(data) - gram + 1
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first, last): the least gram (the first of equals) of every window inside one of the stretches
    [start, end), with the first and the last start of the windows it is the least of."""
    nothing = np.empty(0, np.int64)
    width = length - GRAM + 1
    fits = ends - starts >= length
    if not fits.any():
        return nothing, nothing, nothing
    h = gram_hashes(data)
    n = len(h)
    bits = np.uint64(max(1, n.bit_length()))
    ranked = ((h >> bits) << bits) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-(n + width) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])  # one per window of ``length`` bytes
    valid = np.zeros(len(least) + 1, np.int64)
    np.add.at(valid, starts[fits], 1)
    np.add.at(valid, ends[fits] - length + 1, -1)
    begin = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    chosen = (least[begin] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    change = np.flatnonzero(chosen[1:] != chosen[:-1])  # windows of one anchor follow each other
    first, last = np.append(0, change + 1), np.append(change, len(chosen) - 1)
    return chosen[first], begin[first], begin[last]


def equal_windows(text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(position, group): positions from which the same ``length`` symbols occur more than once, with a number per string.

    Suffixes are ordered by doubling up to ``length`` symbols; from the Burrows-Wheeler transform of that order the
    common prefixes of neighbours are derived level by level.
    """
    n = len(text)
    if n < length + 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if 3 * n.bit_length() > 64:
        raise ValueError(f"{n} symbols are too many to be ordered at once")
    index_bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << index_bits) - np.uint64(1)
    symbols = text.astype(np.uint64) + np.uint64(1)
    rank, known, order, marks = symbols, 1, None, None
    while known < length:
        if known == 1:  # four symbols at once
            key = np.zeros(n, np.uint64)
            for k in range(4):
                key <<= np.uint64(9)
                key[:n - k] |= symbols[k:]
            step = 4
        else:
            shifted = np.zeros(n, np.uint64)
            shifted[:n - known] = rank[known:]
            key = (rank << index_bits) | shifted
            step = 2 * known
        # Sorting key and place in one number is faster than sorting places; a block is small enough for both.
        order = (np.sort((key << index_bits) | np.arange(n, dtype=np.uint64)) & mask).astype(np.int64)
        ordered = key[order]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        known = step
        if known == START_LEVEL:
            marks = rank.copy()
    return _expand(text, order, marks, length)


def _expand(text: np.ndarray, order: np.ndarray, marks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first backward extension over intervals of the suffix order, up to common prefixes of ``length``."""
    n = len(text)
    last_column = text[order - 1]  # the transform: the symbol before each suffix
    by_symbol = np.argsort(last_column, kind="stable")
    to_front = np.empty(n, np.int64)  # where the suffix one symbol longer stands
    to_front[by_symbol] = np.arange(n)
    symbol = last_column[by_symbol]
    same = symbol[1:] == symbol[:-1]
    following = np.full(n, n, np.int64)  # the next row with the same last symbol
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous = np.full(n, -1, np.int64)
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]

    seen = np.zeros(n + 1, bool)  # boundary before row i: a common prefix shorter than the level is known
    seen[0] = seen[n] = True
    group = marks[order]
    seen[1:n] = group[1:] != group[:-1]
    low = np.flatnonzero(seen[:n])
    high = np.append(low[1:], n)
    for _ in range(START_LEVEL, length):
        size = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        ends = following[rows] >= np.repeat(high, size)
        begins = previous[rows] < np.repeat(low, size)
        new_low, new_high = np.sort(to_front[rows[begins]]), np.sort(to_front[rows[ends]]) + 1
        fresh = ~seen[new_high]
        low, high = new_low[fresh], new_high[fresh]
        if not len(low):
            break
        seen[high] = True
    several = ~seen[:n] | ~seen[1:]
    return order[several], np.cumsum(seen[:n])[several]


def _merge(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches covered by windows from ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    first, last = np.append(0, cut + 1), np.append(cut, len(starts) - 1)
    return [(int(a), int(b) + length) for a, b in zip(starts[first], starts[last])]


def repeats_in_block(contexts: list[bytes], places: np.ndarray, several: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per context the stretches covered by strings of ``length`` bytes that occur again in another place.

    ``places`` says where a context begins, as numbers that differ between documents by more than any length, so that
    a place seen in two overlapping contexts is one place; ``several`` marks contexts that stand for more than one place.
    """
    parts, at, offsets = [], 0, []
    for c in contexts:
        offsets.append(at)
        parts.append(np.frombuffer(c, np.uint8).astype(np.uint16) + np.uint16(1))
        parts.append(np.zeros(1, np.uint16))
        at += len(c) + 1
    found, group = equal_windows(np.concatenate(parts), length)
    begin = np.asarray(offsets)
    owner = np.searchsorted(begin, found, side="right") - 1
    sizes = np.asarray([len(c) for c in contexts])
    inside = found - begin[owner] + length <= sizes[owner]
    found, owner, group = found[inside], owner[inside], group[inside]
    if len(found):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = places[owner] + found - begin[owner]
        apart = np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first)
        again = apart | np.logical_or.reduceat(several[owner], first)
        kept = np.repeat(again, np.diff(np.append(first, len(group))))
        by_place = np.argsort(found[kept])
        found, owner = found[kept][by_place], owner[kept][by_place]
    bounds = np.searchsorted(owner, np.arange(len(contexts) + 1))
    return [_merge(found[a:b] - begin[i], length) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def stretches(contexts: list[bytes], lefts: list[int], anchors: list[int], several: list[bool],
              length: int = LENGTH) -> tuple[list[tuple[int, int, int]], list[list[tuple[int, int, int, bool]]]]:
    """Compares the contexts of each anchor range by range: (settled, open).

    All windows of a range (of how far a window begins before the anchor) share a core. Stretches with equal cores that
    are equal as a whole are ``settled`` repeats (context, from, to). A stretch that is alone of its kind beside others
    with its core is ``open``, and so is one of each other kind: (context, from, to, stands for several places), in one list per
    core. Equal windows have equal anchors, ranges and cores, so no repeat is between two lists. A core that only one
    context has holds no repeat. Stretches of one range begin at different places, so none meets itself.
    """
    width = length - GRAM + 1
    step = -(-width // RANGES)
    ranges = [(a, min(a + step, width)) for a in range(0, width, step)]
    cores: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
    for n, (data, left, anchor) in enumerate(zip(contexts, lefts, anchors)):
        least = length - len(data) + left
        for r, (a, b) in enumerate(ranges):
            low, high = max(a, least), min(b - 1, left)
            if low <= high:
                key = (anchor, r, xxhash.xxh3_64_intdigest(data[left - a:left - b + 1 + length]))
                cores.setdefault(key, []).append((n, left - high, left - low + length))
    settled, open_ = [], []
    for members in cores.values():
        if len(members) == 1:
            continue
        kinds: dict[bytes, list[tuple[int, int, int]]] = {}
        for n, low, high in members:
            left = lefts[n]
            kinds.setdefault((left - low).to_bytes(2, "little") + contexts[n][low:high], []).append((n, low, high))
        alone = False
        for same in kinds.values():
            if len(same) > 1:
                settled.extend(same)
            else:
                alone = alone or not several[same[0][0]]
        if alone and len(kinds) > 1:
            open_.append([(*same[0], len(same) > 1 or several[same[0][0]]) for same in kinds.values()])
    return settled, open_


def runs(groups: list[list[tuple[int, int, int, bool]]], most: int) -> Iterator[list[tuple[int, int, int, bool]]]:
    """Open stretches of whole groups, together at most ``most`` symbols with their ends (or one group)."""
    run, volume = [], 0
    for group in groups:
        size = sum(high - low + 1 for _, low, high, _ in group)
        if run and volume + size > most:
            yield run
            run, volume = [], 0
        run.extend(group)
        volume += size
    if run:
        yield run


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keys(text: str) -> list[Column]:
    """128 bits that tell a document: rows with the same id and text share them, and their results."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2")]


def _slices(docs: DataFrame) -> DataFrame:
    """(k1, k2, base, total, bytes): each document in slices; a slice repeats the last two windows of the one before."""
    size = F.length("bytes")
    count = F.greatest(F.lit(1), F.ceil(size / F.lit(SLICE)).cast("int"))
    cut = docs.select("k1", "k2", "bytes", F.explode(F.sequence(F.lit(0), count - 1)).alias("i"))
    base = F.greatest(F.lit(0), F.col("i") * SLICE - 2 * LENGTH)
    return cut.select("k1", "k2", "i", base.alias("base"), size.alias("total"), F.substring(
        F.col("bytes"), base + 1, (F.col("i") + 1) * SLICE + 2 * LENGTH - base).alias("bytes"))


def anchors(docs: DataFrame) -> DataFrame:
    """(k1, k2, pos, left, right, anchor, context): every anchor with the hash of its context."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pieces, out = batch["bytes"].tolist(), []
            first = 0
            while first < len(pieces):
                last, volume = first, 0
                while last < len(pieces) and (last == first or volume + len(pieces[last]) <= SLICE):
                    volume += len(pieces[last])
                    last += 1
                out.append(_anchor_rows(batch.iloc[first:last], pieces[first:last]))
                first = last
            yield pd.concat(out) if out else pd.DataFrame(columns=names)

    names = ["k1", "k2", "pos", "left", "right", "anchor", "context"]
    return _slices(docs).filter(F.col("total") >= LENGTH).mapInPandas(
        find, "k1 long, k2 long, pos long, left int, right int, anchor long, context long")


def _anchor_rows(batch: pd.DataFrame, pieces: list[bytes]) -> pd.DataFrame:
    joined = b"".join(pieces) + bytes(LENGTH)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    starts = ends - [len(p) for p in pieces]
    at, first, last = anchors_of(data, starts, ends)
    owner = np.searchsorted(ends, at, side="right")
    base, number = (batch[c].to_numpy()[owner] for c in ("base", "i"))
    pos = at - starts[owner] + base
    # A slice answers for the anchors of its own stretch; those near its edges were seen with their whole context.
    own = (pos >= number * SLICE) & (pos < (number + 1) * SLICE)
    at, owner, pos = at[own], owner[own], pos[own]
    left, right = at - first[own], last[own] + LENGTH - at
    gram = gram_hashes(data)[at].view(np.int64) if len(at) else np.empty(0, np.int64)
    digest = [_signed(xxhash.xxh3_64_intdigest(joined[a:b], seed=x)) for a, b, x in zip(
        (at - left).tolist(), (at + right).tolist(), left.tolist())]
    return pd.DataFrame({"k1": batch["k1"].to_numpy()[owner], "k2": batch["k2"].to_numpy()[owner], "pos": pos,
                         "left": left.astype("int32"), "right": right.astype("int32"), "anchor": gram,
                         "context": np.asarray(digest, np.int64)})


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, context, bytes, left, n) of one place of each wanted class; ``wanted`` holds its place (k1, k2, pos, left, right)."""
    slots = wanted.select(F.pmod("k1", F.lit(TEXT_SLOTS)).alias("_slot")).distinct()  # at most TEXT_SLOTS rows
    near = docs.join(F.broadcast(slots), F.pmod("k1", F.lit(TEXT_SLOTS)) == F.col("_slot"), "left_semi")
    per_text = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "context", "pos", "left", "right", "n")).alias("places"))
    place = near.dropDuplicates(["k1", "k2"]).join(per_text, ["k1", "k2"]).select("k1", "k2", "bytes", F.explode("places").alias("p"))
    start = (F.col("p.pos") - F.col("p.left") + 1).cast("int")
    return place.select("p.anchor", "p.context", "p.left", "p.n", "k1", "k2", (F.col("p.pos") - F.col("p.left")).alias("start"),
                        F.substring(F.col("bytes"), start, F.col("p.left") + F.col("p.right")).alias("bytes"))


def _cut_by_range(found: DataFrame) -> DataFrame:
    """Spans of classes whose anchor has too many: (anchor, context, from, to), by cores of ever narrower ranges."""

    def cores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each range of window offsets cut into ``FAN``: (parent id, range, hash of the core, hash of the whole)."""
        for batch in batches:
            out = []
            for anchor, context, data, left, group, low, high in zip(*(batch[c] for c in (
                    "anchor", "context", "bytes", "left", "group", "low", "high"))):
                # Offsets o in [low, high): the window starts o bytes before the anchor.
                step = -(-(high - low) // FAN)
                for a in range(low, high, step):
                    b = min(a + step, high)
                    # The core lies in every window of the range; of the windows those count that fit the context.
                    lo, hi = max(a, LENGTH - (len(data) - left)), min(b - 1, left)
                    if lo > hi:
                        continue
                    core = data[left - a:left - b + 1 + LENGTH]
                    whole = data[left - hi:left - lo + LENGTH]
                    digest = xxhash.xxh3_64_intdigest(core, seed=a * 1009 + b) ^ (group & (1 << 64) - 1)
                    out.append((anchor, context, data, left, a, b, _signed(digest), _signed(xxhash.xxh3_64_intdigest(whole, seed=lo * 1009 + hi)),
                                left - hi, left - lo + LENGTH))
            yield pd.DataFrame(out, columns=["anchor", "context", "bytes", "left", "low", "high", "group", "whole", "from", "to"])

    schema = ("anchor long, context long, bytes binary, left int, low int, high int, group long, whole long, from int, to int")
    spans = None
    open_ = found.select("anchor", "context", "bytes", "left", F.col("anchor").alias("group"), F.lit(0).alias("low"),
                         F.lit(LENGTH - GRAM + 1).alias("high"))
    width = LENGTH - GRAM + 1
    while width > 1:
        cut = _written(open_.mapInPandas(cores, schema), "cores")
        width = -(-width // FAN)
        classes = cut.groupBy("group", "whole").agg(F.count(F.lit(1)).alias("places"))
        groups = classes.groupBy("group").agg(F.count(F.lit(1)).alias("kinds"))
        # Equal wholes cover each other; a whole alone among others of its core is looked at more closely.
        settled = cut.join(classes.filter("places > 1"), ["group", "whole"], "left_semi").select("anchor", "context", "from", "to")
        spans = settled if spans is None else spans.union(settled)
        lone = classes.filter("places = 1").join(groups.filter("kinds > 1"), "group", "left_semi").select("group", "whole")
        mixed = groups.filter("kinds > 1").select("group")
        # Of settled wholes one stays: the windows of a lone one may occur in it.
        partners = mixed.join(lone.select("group").distinct(), "group", "left_semi")
        open_ = cut.filter(F.col("high") - F.col("low") > 1).join(partners, "group", "left_semi").dropDuplicates(
            ["group", "whole"]).select("anchor", "context", "bytes", "left", "group", "low", "high")
    return spans


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, from, to): stretches of documents that are to go, not yet merged. ``k1, k2`` tell a text."""
    bodies = docs.select(*_keys(text), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("bytes"))
    placed = _written(anchors(bodies), "anchors")
    classes = _written(placed.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "pos", "left", "right")).alias("at")), "classes")
    kinds = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = kinds.filter("kinds > 1 AND least = 1").select("anchor", "kinds")
    wanted = _written(classes.join(mixed, "anchor").select("anchor", "context", "n", "at.*", "kinds"), "wanted")
    found = _contexts(bodies, wanted.filter(F.col("kinds") <= MOST))
    volume = wanted.filter(F.col("kinds") <= MOST).agg(F.sum(F.col("left") + F.col("right"))).first()[0] or 0
    blocks = max(1, -(-volume // BLOCK_BYTES))

    def expand(batch: pd.DataFrame) -> pd.DataFrame:
        data, several = batch["bytes"].tolist(), (batch["n"] > 1).tolist()
        settled, open_ = stretches(data, batch["left"].tolist(), batch["anchor"].tolist(), several)
        spans_ = [x for x in settled if not several[x[0]]]
        texts = batch.groupby(["k1", "k2"]).ngroup().to_numpy().astype(np.int64) << 40
        begin = batch["start"].to_numpy()
        for run in runs(open_, RUN_SYMBOLS):
            got = repeats_in_block(
                [data[n][low:high] for n, low, high, _ in run],
                np.asarray([texts[n] + begin[n] + low for n, low, _, _ in run]), np.asarray([x[3] for x in run]))
            spans_ += [(n, low + f, low + t) for (n, low, _, _), each in zip(run, got) if not several[n] for f, t in each]
        joined: list[list[int]] = []
        for n, low, high in sorted(spans_):
            if joined and joined[-1][0] == n and low <= joined[-1][2]:
                joined[-1][2] = max(joined[-1][2], high)
            else:
                joined.append([n, low, high])
        which = [x[0] for x in joined]
        return pd.DataFrame({"anchor": batch["anchor"].to_numpy()[which], "context": batch["context"].to_numpy()[which],
                             "from": [x[1] for x in joined], "to": [x[2] for x in joined]})

    blocked = found.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    of_blocks = blocked.groupBy("block").applyInPandas(expand, "anchor long, context long, from int, to int")
    many = wanted.filter(F.col("kinds") > MOST)
    parts = [of_blocks.select("anchor", "context", "from", "to")]
    if many.limit(1).count():
        parts.append(_cut_by_range(_contexts(bodies, many)))
    parts.append(classes.filter((F.col("n") > 1) & (F.col("at.left") + F.col("at.right") >= LENGTH)).select(
        "anchor", "context", F.lit(0).alias("from"), (F.col("at.left") + F.col("at.right")).alias("to")))
    covered = parts[0]
    for p in parts[1:]:
        covered = covered.union(p)
    covered = _written(covered, "covered")
    here = F.col("pos") - F.col("left")
    return placed.join(covered, ["anchor", "context"]).select(
        "k1", "k2", (here + F.col("from")).alias("from"), (here + F.col("to")).alias("to"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, spans, kept) per row: ``kept`` is the text without its repeats, as bytes."""
    found = _written(spans(docs, text).groupBy("k1", "k2").agg(F.collect_set(F.struct("from", "to")).alias("raw")), "spans")
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    joined = docs.select(F.col(key).alias("key"), body.alias("bytes"), *_keys(text)).join(found, ["k1", "k2"], "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key_, data, raw in zip(batch["key"], batch["bytes"], batch["raw"]):
                merged: list[list[int]] = []
                for f, t in sorted((r["from"], r["to"]) for r in raw) if raw is not None else ():
                    if merged and f <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], t)
                    else:
                        merged.append([f, t])
                edges = [0, *(x for m in merged for x in m), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if merged else data
                rows.append((key_, len(data), len(data) - len(kept), len(merged), merged, kept))
            yield pd.DataFrame(rows, columns=["key", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    source = joined.select(F.struct(F.col("key").alias("v")).alias("key"), "bytes", "raw")
    return source.mapInPandas(
        cut, f"key struct<v: {kind}>, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary"
    ).select(F.col("key.v").alias(key), "n_bytes", "n_removed", "n_spans", "spans", "kept")
