"""Secret scans with multipart credential linking, in built-in functions only.

Strong kinds are found by their pattern alone: assigned secrets, access identifiers, long hexadecimal runs. Weak kinds
(blobs that look random, user or client names that are assigned, endpoints) mean nothing alone. They are linked by an
interval join: every part is put into the scopes that cover its start (stretches of ``2 * REACH`` code points, one from
every multiple of ``REACH`` on, so parts less than ``REACH`` apart share a scope), each scope says which roles occur in
it, and a weak part is reported only where a complementary role does:

* a blob, where an identifier stands in its scope;
* a name, where a secret (assigned, hexadecimal, or a blob) stands in its scope;
* an endpoint, where both an identifier and a secret stand in its scope.

Scopes end with their text, so a join group holds at most the parts of ``2 * REACH`` code points, whatever the data.
Positions come from the gaps between matches: a pattern's matches and the pieces it splits a text into alternate.

Defined results: a NULL or empty text has no parts; every row is scanned on its own and keyed by its place, so equal rows
stay apart; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The strong patterns, their least lengths and the order of kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "blob", "name", "endpoint")
STRONG = KINDS[:3]

#: Runs as the strong patterns find them, without those that are too short anyway.
_LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
_LONG_HEX = r"[0-9a-f]{24,}"
_BLOB = r"[A-Za-z0-9+/_=-]{40,}"
_NAME = r"""(?i:(?:user(?:_?name)?|login|client_?id|access_?key_?id|account))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}"""
_ENDPOINT = r"""(?:https?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|s3)://[^\x00-\x20"'<>]+"""
REACH = 400
#: Any weak part begins with one of these.
_WEAK = f"(?:{_BLOB})|(?:{_NAME})|(?:{_ENDPOINT})"
#: Matches of a text that are handled together.
BLOCK = 512

_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _blocks(values: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` entries."""
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))


def _before(values: Column, combine) -> Column:
    """For every entry what ``combine`` makes of all entries before it, beginning with 0. Block by block, and then over the
    totals of blocks: an array that grew entry by entry would be copied as often as it has entries."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def grown(s: Column, v: Column) -> Column:
        return F.struct(combine(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))

    inner = F.transform(_blocks(values), lambda b: F.aggregate(b, nothing, grown))
    return _let(inner, lambda i: F.flatten(F.zip_with(
        i, F.aggregate(F.transform(i, lambda x: x["at"]), nothing, grown)["out"],
        lambda x, o: F.transform(x["out"], lambda p: combine(o, p)))))


def _found(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches; ``keep`` tests a match. Cheap where nothing matches."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    code = F.lit(KINDS.index(kind))
    sizes = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), hits, lambda g, h: F.struct(
        F.length(g).cast("long").alias("gap"), F.length(h).cast("long").alias("hit"), (keep(h) if keep else F.lit(True)).alias("keep")))

    def placed(x: Column) -> Column:
        starts = _let(F.transform(x, lambda v: v["gap"] + v["hit"]), lambda lengths: _before(lengths, lambda a, b: a + b))
        spans = F.zip_with(starts, x, lambda at, v: F.struct(
            v["keep"].alias("keep"), F.struct((at + v["gap"]).alias("start"), code.alias("kind"), (at + v["gap"] + v["hit"]).alias("end")).alias("span")))
        return F.transform(F.filter(spans, lambda v: v["keep"]), lambda v: v["span"]).cast(_SPAN)

    return F.when(text.rlike(pattern), _let(sizes, placed)).otherwise(_none())


def strong_spans(text: Column) -> Column:
    """Assigned secrets of six or more characters, access identifiers of 20 or more, hexadecimal runs of 24 or more."""
    long_enough = lambda hit: F.length(F.regexp_extract(hit, "^" + ASSIGN, 2)) >= 6
    return F.concat(_found(text, ASSIGN, "assign", long_enough), _found(text, _LONG_ACCESS, "access"), _found(text, _LONG_HEX, "hex"))


def weak_spans(text: Column) -> Column:
    mixed = lambda hit: (F.length(hit) == 40) & hit.rlike("[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]")
    return F.concat(_found(text, _BLOB, "blob", mixed), _found(text, _NAME, "name"), _found(text, _ENDPOINT, "endpoint"))


def _role(kind: Column, *names: str) -> Column:
    return kind.isin(*[KINDS.index(n) for n in names])


def scan(docs: DataFrame, text: str = "text", reach: int = REACH, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) as struct ``row`` with ``strong`` and ``linked``: arrays of (start, kind, end).

    One pass over the texts. Only rows that hold a weak part and any other part send parts to the join; every other
    row sends one marker. The kept columns travel in the marker: leave the text out where it is not needed.
    """
    own = F.struct(*[F.col(c) for c in (docs.columns if keep is None else keep)]).alias("row")
    found = (
        docs.select(F.monotonically_increasing_id().alias("id"), own, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
        .withColumns({"strong": strong_spans(F.col("body")), "weak": weak_spans(F.col("body"))})
        .withColumn("strong", F.sort_array("strong"))
        .drop("body")
    )
    parts = F.when((F.size("weak") > 0) & (F.size("weak") + F.size("strong") > 1), F.concat("strong", "weak")).otherwise(_none())
    nothing = F.struct(F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("bigint").alias("end"))
    rows = found.select("id", "row", "strong", F.explode(F.concat(F.array(nothing), parts)).alias("part"))
    is_part = F.col("part.kind").isNotNull()
    scope = F.floor(F.col("part.start") / reach)
    scoped = rows.select(
        "id", F.when(~is_part, F.col("row")).alias("row"), F.when(~is_part, F.col("strong")).alias("strong"), "part",
        F.explode(F.when(is_part, F.array(scope, scope - 1)).otherwise(F.array(F.lit(-2).cast("long")))).alias("scope"))
    kind = F.col("part.kind")
    within = Window.partitionBy("id", "scope")
    identifier = F.max(_role(kind, "access", "name")).over(within)
    secret = F.max(_role(kind, "assign", "hex", "blob")).over(within)
    complemented = (
        F.when(_role(kind, "blob"), identifier).when(_role(kind, "name"), secret)
        .when(_role(kind, "endpoint"), identifier & secret).otherwise(F.lit(False)))
    # Distributed by row: the window and the final grouping share this one exchange.
    joined = scoped.repartition("id").withColumn("ok", complemented)
    return joined.groupBy("id").agg(
        F.first("row", ignorenulls=True).alias("row"), F.first("strong", ignorenulls=True).alias("strong"),
        F.sort_array(F.collect_set(F.when(F.col("ok"), F.col("part")))).alias("linked")).drop("id")


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _masked(body: Column, spans: Column, mask: str) -> Column:
    """The text with sorted spans replaced. A span whose start lies before the end of an earlier one adds nothing. Texts are cut
    out of the stretch of their block, so that a cut does not count from the beginning of the whole text."""
    def cut(x: Column) -> Column:
        reached = _let(F.transform(x, lambda v: v["end"]), lambda ends: _before(ends, F.greatest))
        rows = F.zip_with(x, reached, lambda v, at: F.struct(v["start"].alias("start"), v["end"].alias("end"), at.alias("at")))

        def block(b: Column) -> Column:
            begin = b[0]["at"]
            end = F.greatest(begin, F.array_max(F.transform(b, lambda v: v["end"])))
            stretch = F.substring(body, (begin + 1).cast("int"), (end - begin).cast("int"))
            return _let(stretch, lambda t: F.array_join(F.transform(b, lambda v: F.when(v["start"] >= v["at"], F.concat(
                F.substring(t, (v["at"] - begin + 1).cast("int"), (v["start"] - v["at"]).cast("int")), F.lit(mask))).otherwise(F.lit(""))), ""))

        done = F.array_max(F.transform(x, lambda v: v["end"]))
        joined = _let(rows, lambda r: F.array_join(F.transform(_blocks(r), block), ""))
        return F.concat(joined, F.substring(body, (done + 1).cast("int"), F.length(body)))

    return _let(spans, cut)


def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]", reach: int = REACH) -> DataFrame:
    """The rows with every found span replaced by ``mask``; overlapping spans become one. NULL texts stay NULL.

    Only texts that hold a weak part go through the exchange of the interval join; the others are masked where they are.
    """
    linked = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(_WEAK)

    def masked(rows: DataFrame, body: Column, spans: Column, column) -> DataFrame:
        clean = F.when(F.size(spans) > 0, _masked(body.cast("string"), spans, mask)).otherwise(body)
        return rows.select(*[clean.alias(c) if c == text else column(c).alias(c) for c in docs.columns])

    plain = docs.filter(~linked)
    own = F.sort_array(strong_spans(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    alone = masked(plain, F.col(text), own, F.col)
    scanned = scan(docs.filter(linked), text, reach)
    joined = masked(scanned, F.col(f"row.{text}"), F.sort_array(F.concat("strong", "linked")), lambda c: F.col(f"row.{c}"))
    return alone.unionByName(joined)
