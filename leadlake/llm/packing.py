"""Packing: documents as token sequences of a fixed window with little padding.

1. Every document is tokenized once and cut at whole windows; what is left over is one shorter piece.
2. The histogram of piece lengths (at most one row per length up to the window) decides the layout. Combinations of a
   few lengths that fill a window exactly are enumerated, a non-negative least squares fit says how often each should
   be used so that the combinations together reproduce the histogram, and the counts are rounded down to what is there.
3. The rest of the histogram is packed greedily, longest first, always with the longest piece that still fits.
4. The layout is a table of rank intervals per length. Pieces get a rank within their length by slices of a uniform
   hash, so a length that holds a third of all pieces is ranked by many tasks, and look their place up by rank.

Only the histogram and the layout (both bounded by the window, not by the data) reach the driver.

Defined results: a NULL or empty text is its end token alone; equal rows are packed one by one; an empty table gives
no pieces; a document of any length is cut into windows; working columns cannot clash, the caller names what to keep.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.session import literal_rows, shared_dir

WINDOW = 4096
#: Memory bounds of one worker, in remembered runs and stems, and how many texts it opens at a time.
MAX_RUNS = 600_000
MAX_STEMS = 400_000
TEXTS = 1024
#: How many lengths a combination has at most, and how many combinations the fit sees.
DEPTH = 4
MAX_COMBINATIONS = 6000
#: Longer runs and stems are tokenized where they occur and not remembered.
LONG = 64
#: Punctuation that is always a token of its own after a letter, and never part of a contraction or a special token.
_END = ".,!?;:*&$%#\"()"
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class WordIds:
    """Token ids per run without ASCII white space, as little-endian bytes, remembered up to a bound.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its runs in a row. A run
    is looked up by its stem and the plain punctuation at its end, which the tokenizer always cuts apart; stems that are
    one word of Latin letters are tokenized many at a time and told apart by the tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        ends = [i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[ends] = True
        self.runs: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stems: list[str]) -> None:
        words = [s for s in stems if s.isalpha() and (s.isascii() or max(s) < "\u0100")]
        for i in range(0, len(words), 512):
            part = words[i:i + 512]
            ids = self._encode([" ".join(part)])[0]
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(part):
                raise ValueError("a word of letters does not end with one word-end token")
            data, at = ids.tobytes(), 0
            for stem, to in zip(part, (4 * last).tolist()):
                self.stems[stem] = data[at:to]
                at = to
        plain = set(words)
        rest = [s for s in stems if s not in plain]
        for i in range(0, len(rest), 4096):
            part = rest[i:i + 4096]
            self.stems.update(zip(part, (ids.tobytes() for ids in self._encode(part))))

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        if len(self.runs) > MAX_RUNS:
            self.runs.clear()
        if len(self.stems) > MAX_STEMS:
            self.stems.clear()
        # Runs are cut and told apart in C, so a run is looked up once however often the texts hold it.
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        ends, coded = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        runs, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        ids = list(map(self.runs.get, runs))
        # Lists of texts only: a pair kept per run would make the garbage collector walk through them over and over.
        new = [n for n, known in enumerate(ids) if known is None]
        heads, tails = [], []
        for n in new:
            head, tail = _split(runs[n])
            heads.append(head)
            tails.append(tail)
        stems = self.stems
        self._learn([s for s in {*heads, *tails} if s not in stems])
        for n, head, tail in zip(new, heads, tails):
            ids[n] = stems[head] + stems[tail]
            if len(runs[n]) <= LONG:
                self.runs[runs[n]] = ids[n]
        for stem in {s for s in (*heads, *tails) if len(s) > LONG}:
            del stems[stem]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start, size = (np.cumsum(size) - size)[code], size[code]
        after = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(start - after[:-1], size)
        place += np.arange(len(place))
        data, at = np.frombuffer(b"".join(ids), "<u4")[place].tobytes(), (4 * after[ends]).tolist()
        return [data[i:j] for i, j in zip(at, at[1:])]


def _split(run: str) -> tuple[str, str]:
    """Stem and end of a run. A-Z count as lower case unless that could write a special token."""
    stem = run.rstrip(_END)
    if stem and stem[-1].isalpha() and stem[-1] < "\u0100":
        end = run[len(stem):]
    else:
        stem, end = run, ""
    if stem.isalpha():
        stem = stem.lower() if stem.isascii() else stem.translate(_LOWER)
    return stem, end


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
               window: int = WINDOW) -> DataFrame:
    """Pieces (key, start, length, ids_crc32, doc_tokens): whole windows and one rest per document."""
    end = np.asarray([end_id], "<u4").tobytes()

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = load(tokenizer_path)
        for batch in batches:
            rows = []
            texts = batch["text"].tolist()
            for first in range(0, len(texts), TEXTS):
                for n, ids in enumerate(words.of(texts[first:first + TEXTS]), first):
                    ids += end
                    total = len(ids) // 4
                    rows.extend((n, at, min(window, total - at), zlib.crc32(ids[4 * at:4 * (at + window)]), total)
                                for at in range(0, total, window))
            which, start, length, crc, total = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pd.DataFrame({"key": batch["key"].iloc[which].array, "start": start, "length": length, "ids_crc32": crc,
                                "doc_tokens": total}).astype({c: "int64" for c in ("start", "length", "ids_crc32", "doc_tokens")})

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.struct(F.col(key).alias("v")).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    pieces = source.mapInPandas(
        tokenize, f"key struct<v: {kind}>, start long, length long, ids_crc32 long, doc_tokens long")
    return pieces.select(F.col("key.v").alias(key), "start", "length", "ids_crc32", "doc_tokens")


def combinations(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Exact fillings of a window by two to ``DEPTH`` lengths that occur, commonest lengths first; all sums are ``window``."""
    lengths = np.flatnonzero(counts[:window])
    found: set[tuple[int, ...]] = set()
    for a in lengths:
        if counts[window - a] and a <= window - a:
            found.add((int(window - a), int(a)))
    common = lengths[np.argsort(-counts[lengths], kind="stable")]
    for depth in range(3, DEPTH + 1):
        # The first parts range over common lengths, the last one closes the window.
        grid = common[: max(2, int(round(MAX_COMBINATIONS ** (1 / (depth - 1)))))]
        sums = {(int(a),): int(a) for a in grid}
        for _ in range(depth - 2):
            sums = {(*k, int(a)): v + int(a) for k, v in sums.items() for a in grid if a <= k[-1] and v + a < window}
        found.update(tuple(sorted((*k, window - v), reverse=True)) for k, v in sums.items() if counts[window - v])
    return sorted(found)


def fit_counts(patterns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative x minimising |A x - h|: column p of A says how often each length occurs in pattern p.

    Projected gradient steps with a diagonal bound on the curvature; A is kept as lists of (length, pattern) entries.
    """
    size = [len(p) for p in patterns]
    col = np.repeat(np.arange(len(patterns)), size)
    row = np.concatenate([np.asarray(p) for p in patterns])
    target = counts.astype(float)
    degree = np.bincount(row, minlength=len(counts))
    bound = np.bincount(col, weights=degree[row], minlength=len(patterns))  # row sums of |A'A|
    x = np.zeros(len(patterns))
    for _ in range(rounds):
        gap = target - np.bincount(row, weights=x[col], minlength=len(counts))
        x = np.maximum(0, x + np.bincount(col, weights=gap[row], minlength=len(patterns)) / bound)
    return x


def plan_layout(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Layout rows (length, first_rank, repeats, per_sequence, first_sequence, offset).

    Pieces of ``length`` with ranks from ``first_rank`` on, ``repeats * per_sequence`` of them, go ``per_sequence`` at a
    time into ``repeats`` sequences from ``first_sequence`` on, from ``offset`` on.
    """
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    used = np.zeros(window + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def place(parts: dict[int, int], repeats: int) -> None:
        nonlocal sequences
        offset = 0
        for length, times in parts.items():
            rows.append((length, int(used[length]), repeats, times, sequences, offset))
            used[length] += repeats * times
            left[length] -= repeats * times
            offset += length * times
        sequences += repeats

    def many(pattern: tuple[int, ...]) -> dict[int, int]:
        return {length: pattern.count(length) for length in sorted(set(pattern), reverse=True)}

    if left[window]:
        place({window: 1}, int(left[window]))
    patterns = combinations(left, window)
    if patterns:
        wanted = fit_counts(patterns, left)
        for p in np.argsort(-wanted, kind="stable"):
            parts = many(patterns[p])
            repeats = min(int(round(wanted[p])), *(int(left[length]) // times for length, times in parts.items()))
            if repeats > 0:
                place(parts, repeats)
    while left.any():
        room, parts = window, {}
        present = np.flatnonzero(left)
        while room:
            at = np.searchsorted(present, room, side="right") - 1
            while at >= 0 and left[present[at]] <= parts.get(int(present[at]), 0):
                at -= 1
            if at < 0:
                break
            length = int(present[at])
            times = min(int(left[length]) - parts.get(length, 0), room // length)
            parts[length] = parts.get(length, 0) + times
            room -= times * length
        place(parts, min(int(left[length]) // times for length, times in parts.items()))
    return rows


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``pieces`` is read more than once: give a written table.

    A sequence is padded to the window unless its tokens come to a power of two; the layout knows no other waste.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()  # at most one row per length up to the window
    layout = plan_layout({r["length"]: r["count"] for r in counted}, window)
    fields = "length long, first_rank long, repeats long, per_sequence long, first_sequence long, at long"
    table = _as_table(spark, layout, fields)
    others = [c for c in pieces.columns if c != "length"]
    slices = max(1, sum(r["count"] for r in counted) // 100_000) * 4
    cut = pieces.withColumn("_slice", F.pmod(F.xxhash64(*pieces.columns), F.lit(slices)))
    sizes = cut.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_slice").orderBy(*others)
    ranked = (cut.withColumn("_in", F.row_number().over(within) - 1).join(offsets, ["length", "_slice"])
              .withColumn("_rank", F.col("_before") + F.col("_in")).drop("_slice", "_in", "_before"))
    p, t = ranked.alias("p"), F.broadcast(table).alias("t")
    step = F.col("_rank") - F.col("t.first_rank")
    inside = (step >= 0) & (step < F.col("t.repeats") * F.col("t.per_sequence"))
    return p.join(t, (F.col("p.length") == F.col("t.length")) & inside).select(
        *[F.col(f"p.{c}") for c in pieces.columns],
        (F.col("t.first_sequence") + F.floor(step / F.col("t.per_sequence"))).alias("sequence_id"),
        (F.col("t.at") + F.pmod(step, F.col("t.per_sequence")) * F.col("p.length")).alias("offset"))


def _as_table(spark, rows: list[tuple], ddl: str) -> DataFrame:
    """The layout as a table: one text literal, opened by built-in functions."""
    names = [part.split() for part in ddl.split(", ")]
    if not rows:
        return literal_rows(spark, ddl.replace(", ", ","), [tuple([None] * len(names))]).limit(0)
    lines = ";".join(",".join(map(str, r)) for r in rows)
    line = F.explode(F.split(F.lit(lines), ";")).alias("line")
    return spark.range(1).select(line).select(
        *[F.split("line", ",")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(names)])


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their place; the pieces (a few numbers each) are written to the shared folder once."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "pieces")
    cut_pieces(docs, tokenizer_path, end_id, key, text, window).write.parquet(folder)
    return pack(spark.read.parquet(folder), window)
