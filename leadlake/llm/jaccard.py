"""Near duplicates by an exact Jaccard join on word shingles.

* Texts with the same shingle set form one class at once, so thousands of copies count as one node.
* Shingles are ordered rare first, by a frequency table of bounded size over all documents (shingles share its cells by
  hash, 16 million at most; the table steers the work, any order gives the same links). A set of n shingles that is similar to another one
  must share one of its first n - ceil(0.8 n) + 1 shingles with it: only those prefixes are shuffled.
* Candidates are pairs on a shared prefix shingle that pass the length filter and the positional filter (how much can
  still be shared after this place), then the suffix filter (64 ranges of hashes; differing range counts bound
  the symmetric difference), and are verified once on the full sets.
* First every set is compared with the most central set of each shingle's group, the one with the fewest rarer
  shingles. That is linear in the group and links most of a family of near copies. Then only sets that are still in
  different components are compared, so no link that could join two components is lost and links inside a component
  are not listed one by one.

Defined results: a NULL, empty or blank text has no shingles and is a component of its own; fewer than five words are one
shingle; equal rows get equal results; NULL keys are left out of a component's least key; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.components import _written, components

WORDS = 5
PERCENT = 80
#: Cells of the frequency table (shared by hash): about one per ``CELL_LOAD`` shingles, within fixed bounds.
CELL_LOAD = 16
CELL_BITS = (16, 24)
CELL_SLICE = 1 << 16
RANGES = 64
#: A list of sets to verify goes to all tasks up to this many entries (three numbers each).
MAX_LISTED = 1 << 20
MAX_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Eight-byte hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MAX_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        return found


_HASHES = _Hashes()


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct shingles of a text in order of their hashes; A-Z count as lower case, other bytes as they are."""
    runs = text.lower().split()
    if not runs:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(_HASHES.__getitem__, runs)), "<u8")
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + h[k:len(h) - size + 1 + k]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX2
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def _texts(docs: DataFrame, text: str, *columns: Column) -> DataFrame:
    return docs.select(*columns, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))


def frequency_levels(docs: DataFrame, text: str) -> bytes:
    """One byte per cell: the logarithm of how many distinct shingles of documents fall into it."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    bits = min(max((size // (6 * CELL_LOAD)).bit_length(), CELL_BITS[0]), CELL_BITS[1])
    shift, cells = np.uint64(64 - bits), 1 << bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            for body in batch["_text"]:
                at, n = np.unique(shingles(body) >> shift, return_counts=True)
                total[at.astype(np.int64)] += n.astype(np.uint32)
        parts = [zlib.compress(part.tobytes(), 1) for part in total.reshape(-1, CELL_SLICE)]
        yield pd.DataFrame({"slice": range(len(parts)), "counts": parts})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CELL_SLICE)
        for part in parts["counts"]:
            total += np.frombuffer(zlib.decompress(part), np.uint32)
        level = np.minimum(255, 4 * np.log2(total + 1)).astype(np.uint8)
        return pd.DataFrame({"slice": parts["slice"].iloc[:1], "counts": [level.tobytes()]})

    schema = "slice long, counts binary"
    rows = _texts(docs, text).mapInPandas(count, schema).groupBy("slice").applyInPandas(add, schema).collect()
    level = np.zeros((cells // CELL_SLICE, CELL_SLICE), np.uint8)
    for r in rows:
        level[r["slice"]] = np.frombuffer(r["counts"], np.uint8)
    return level.tobytes()


def signatures(docs: DataFrame, key: str, text: str, levels: bytes) -> DataFrame:
    """(key, text_key, n, digest, prefix, ranges) of every document."""
    table = docs.sparkSession.sparkContext.broadcast(levels)
    shift = np.uint64(64 - (len(levels).bit_length() - 1))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            n, digest, prefix, ranges = [], [], [], []
            for body in batch["_text"]:
                found = shingles(body)
                size = len(found)
                n.append(size)
                digest.append(xxhash.xxh3_128_digest(found.tobytes()))
                order = np.argsort(level[(found >> shift).astype(np.int64)], kind="stable")
                prefix.append(found[order[:size - -(-PERCENT * size // 100) + 1]].view(np.int64) if size else [])
                held = np.bincount((found & np.uint64(RANGES - 1)).astype(np.int64), minlength=RANGES)
                ranges.append(np.minimum(held, 127).astype(np.int8))  # clipping keeps differences a lower bound
            yield pd.DataFrame({"key": batch["key"].array, "text_key": batch["text_key"], "n": n, "digest": digest,
                                "prefix": prefix, "ranges": ranges})

    kind = docs.schema[key].dataType.simpleString()
    source = _texts(docs, text, F.struct(F.col(key).alias("v")).alias("key"), _text_key(text).alias("text_key"))
    return source.mapInPandas(
        sign, f"key struct<v: {kind}>, text_key long, n long, digest binary, prefix array<long>, ranges array<tinyint>"
    ).select(F.col("key.v").alias("key"), "text_key", "n", "digest", "prefix", "ranges")


def _text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _needed(a: Column, b: Column) -> Column:
    """Least overlap of sets of these sizes that makes them similar: ceil(t / (1 + t) * (a + b))."""
    return F.floor(((a + b) * PERCENT + (99 + PERCENT)) / (100 + PERCENT))


def _may_link(n_a: Column, n_b: Column, pos_a: Column, pos_b: Column) -> Column:
    """Length filter, and the positional filter as it holds at the first shared shingle of a pair."""
    length = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT
    return length & (F.least(n_a - pos_a, n_b - pos_b) >= _needed(n_a, n_b))


def _suffix_ok(n_a: Column, n_b: Column, ranges_a: Column, ranges_b: Column) -> Column:
    """Suffix filter: counts per range that differ bound what the sets can share."""
    apart = F.aggregate(F.zip_with(ranges_a, ranges_b, lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda s, x: s + x)
    return F.floor((n_a + n_b - apart) / 2) >= _needed(n_a, n_b)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar, each looked at once."""
    side = classes.select("node", "n", "ranges")
    a, b = side.toDF("a", "n_a", "ranges_a"), side.toDF("b", "n_b", "ranges_b")
    narrowed = _written(
        pairs.distinct().join(a, "a").join(b, "b").filter(_suffix_ok(*[F.col(c) for c in ("n_a", "n_b", "ranges_a", "ranges_b")]))
        .select("a", "b", "n_a", "n_b"), "candidates")
    nodes = narrowed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = _written(classes.join(nodes, "node", "left_semi").select("node", "text_key", "rep"), "wanted")
    # A list of bounded size goes to the texts; a longer one and the texts meet by shuffle.
    listed = F.broadcast(wanted) if wanted.count() <= MAX_LISTED else wanted
    same = (F.col("d.text_key") == F.col("w.text_key")) & F.col("d.rep").eqNullSafe(F.col("w.rep"))
    found = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"), _text_key(text).alias("text_key")).alias("d").join(
        listed.alias("w"), same).select("w.node", "d.text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # rows that repeat key and text
        for batch in batches:
            new = ~(batch["node"].duplicated() | batch["node"].isin(seen))
            seen.update(batch["node"][new])
            yield pd.DataFrame({"node": batch["node"][new], "tokens": [shingles(body).view(np.int64) for body in batch["_text"][new]]})

    of_node = _texts(found, "text", F.col("node")).mapInPandas(read, "node long, tokens array<long>")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        narrowed.join(of_node.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
        .join(of_node.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
        .filter(shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * PERCENT).select("a", "b"))


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_key, n, component_id) per row."""
    levels = frequency_levels(docs, text)
    signed = _written(signatures(docs, key, text, levels), "signatures")
    classes = _written(
        signed.filter("n > 0").groupBy("digest").agg(
            F.min(F.struct("key", "text_key")).alias("least"), F.min("key").alias("least_key"), F.first("n").alias("n"),
            F.first("prefix").alias("prefix"), F.first("ranges").alias("ranges"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "n", "prefix", "ranges", "least_key",
                F.col("least.key").alias("rep"), F.col("least.text_key").alias("text_key")), "classes")

    postings = classes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    order = Window.partitionBy("token").orderBy("pos", "node")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    me = F.struct("node", "n", "pos")
    shared = _written(
        postings.select("token", "node", "n", "pos", F.first(me).over(so_far).alias("hub"), F.lead("node").over(order).alias("next"))
        .filter((F.col("hub.node") != F.col("node")) | F.col("next").isNotNull()).drop("next"), "postings")

    to_hub = shared.filter(
        (F.col("hub.node") != F.col("node")) & _may_link(F.col("n"), F.col("hub.n"), F.col("pos"), F.col("hub.pos"))
    ).select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
    stars = _written(_verified(to_hub, classes, docs, key, text), "links")
    first = _written(components(stars), "components")

    known = F.coalesce("component", "node").alias("component")
    placed = shared.join(first, "node", "left").select("token", "node", "n", "pos", known)
    mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token")
    open_ = _written(placed.join(mixed, "token", "left_semi").join(classes.select("node", "ranges"), "node"), "open")
    x, y = open_.alias("x"), open_.alias("y")
    across = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
                    & (F.col("x.component") != F.col("y.component"))
                    & _may_link(F.col("x.n"), F.col("y.n"), F.col("x.pos"), F.col("y.pos"))
                    & _suffix_ok(F.col("x.n"), F.col("y.n"), F.col("x.ranges"), F.col("y.ranges"))
                    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    links = _written(stars.union(_verified(across, classes, docs, key, text)), "links")
    grouped = components(links)

    member = classes.join(grouped, "node", "left").select("digest", "least_key", F.coalesce("component", "node").alias("component"))
    least = member.groupBy("component").agg(F.min("least_key").alias("component_id"))
    of_digest = member.join(least, "component").select("digest", "component_id")
    return signed.select("key", "text_key", "n", "digest").join(of_digest, "digest", "left").select(
        "key", "text_key", "n",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) per row: the least key among all documents that links reach."""
    return _grouped(docs, key, text).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that carry the least key of their component; of rows that share key and text one stays.

    Rows without a key have no representative to give way to and stay.
    """
    kept = _grouped(docs, key, text).filter(F.col("component_id") == F.col("key")).select(
        F.col("key").alias("_kept_key"), F.col("text_key").alias("_kept_text")).distinct()
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    marked = docs.select(own, F.col(key).alias("_key"), _text_key(text).alias("_text_key"))
    ours = (F.col("_key") == F.col("_kept_key")) & (F.col("_text_key") == F.col("_kept_text"))
    first = marked.join(kept, ours, "left_semi").dropDuplicates(["_key", "_text_key"])
    return first.union(marked.filter(F.col("_key").isNull())).select("row.*")
