"""Chat formatting by incremental black-box rendering.

A template is a function from turns to text; nothing else about it is known. Successive prefixes of a conversation are
rendered and consecutive outputs compared: what the next turn adds is its span. Where an earlier output is no longer a
prefix of the next one, the template has rewritten history, and the turn is marked with the place where that begins.
The text inside a span is found by rendering the same prefix with a probe in place of the text.

Conversations are dealt out by their id and read in order as a stream. A template is given the whole prefix of a conversation,
however long, unless the caller states how many earlier turns a turn's span depends on (its context): then a task holds that many
turns from the first turn on. The own template is no exception: every prefix of a conversation is rendered whole and compared.

Defined results: NULL roles and texts count as empty; rows without an id form one conversation; turns with equal
numbers are ordered by role and text, repeated rows are turns of their own; an empty table gives nothing.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBE = "probe"
#: The context of a template of which nothing is known: all earlier turns.
WHOLE = sys.maxsize

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

Turn = tuple[str, str]
_TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """No control string is left: every one begins with ``<|``. ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


@lru_cache(maxsize=1 << 12)
def _written(turn: Turn) -> str:
    role, text = turn
    return f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}{END}\n"


def render(turns: list[Turn]) -> str:
    """The own template: each turn between control strings, role on the first line."""
    return "".join(map(_written, turns))


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


class Spans:
    """Spans of successive turns of one conversation, for any template. ``context`` is how many earlier turns a span depends on;
    left out, all of them, but none for the own template when this class is used by itself."""

    def __init__(self, template: Callable[[list[Turn]], str], context: int | None = None):
        self.template = template
        self.context = 0 if context is None and template is render else context
        self.turns: list[Turn] = []
        self.shown = template([])
        self.gone = 0

    def add(self, turn: Turn) -> dict:
        """Start, end and text of what the turn adds; where its own text lies; where history was rewritten, or -1."""
        before = self.shown
        mark = PROBE
        probe = self.template([*self.turns, (turn[0], mark)])
        if probe.count(mark) > 1:  # the turns held, or the role, have the very mark: take one that depends on all of them
            mark += hashlib.sha256((probe + turn[0]).encode("utf-8", "surrogatepass")).hexdigest()
            probe = self.template([*self.turns, (turn[0], mark)])
        self.turns.append(turn)
        self.shown = self.template(self.turns)
        same = len(before) if self.shown.startswith(before) else len(os.path.commonprefix([before, self.shown]))
        at = probe.find(mark)
        size = len(self.shown) - (len(probe) - len(mark))
        inner = (self.gone + at, self.gone + at + size) if at >= same and size >= 0 else (-1, -1)
        found = {"start": self.gone + same, "end": self.gone + len(self.shown), "piece": self.shown[same:],
                 "text_start": inner[0], "text_end": inner[1], "rewritten_from": -1 if same == len(before) else self.gone + same}
        if self.context is not None and len(self.turns) > self.context:
            self._let_go()
        return found

    def _let_go(self) -> None:
        rest = self.turns[len(self.turns) - self.context:]
        shorter = self.template(rest)
        self.gone += len(self.shown) - len(shorter)
        self.turns, self.shown = rest, shorter


def successive(template: Callable[[list[Turn]], str], context: int | None = None) -> Spans:
    """Spans as ``format_turns`` makes them: any template, the own one too, is given the whole prefix unless its context is stated."""
    return Spans(template, WHOLE if context is None else context)


def format_turns(turns: DataFrame, template: Callable[[list[Turn]], str] = render, key: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", context: int | None = None) -> DataFrame:
    """One row per turn: (key, number, role, start, end, piece, text_start, text_end, rewritten_from), number from 0.

    ``context`` is how many earlier turns a span of the template depends on; left out, any template, the own one too, is given
    the whole prefix. Joined in order, the pieces are the formatted conversation. Rows of a partition are in order, all of a
    conversation in one partition; a following ``mapInPandas`` may rely on it.
    """
    kind = turns.schema[key].dataType.simpleString()
    source = turns.select(
        F.struct(F.col(key).alias("v")).alias("conv"), F.col(turn).alias("at"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def show(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, spans, number = object(), None, 0
        for batch in batches:
            rows = []
            for conv, who, said in zip(batch["conv"], batch["role"], batch["text"]):
                if conv["v"] != current:
                    current, spans, number = conv["v"], successive(template, context), 0
                rows.append({"conv": conv, "number": number, "role": who, **spans.add((who, said))})
                number += 1
            yield pd.DataFrame(rows, columns=["conv", "number", "role", "start", "end", "piece", "text_start", "text_end", "rewritten_from"])

    ordered = source.repartition("conv").sortWithinPartitions("conv", "at", "role", "text")
    shown = ordered.mapInPandas(
        show, f"conv struct<v: {kind}>, number long, role string, start long, end long, piece string, text_start long, "
              "text_end long, rewritten_from long")
    return shown.select(F.col("conv.v").alias(key), "number", "role", "start", "end", "piece", "text_start", "text_end", "rewritten_from")


def digests(formatted: DataFrame, key: str = "conv_id", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation, read back from the pieces of ``format_turns`` with the own template, as a stream."""
    kind = formatted.schema[key].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, conv = None, None
        for batch in batches:
            done = []
            for at, number, role, start, end, piece, low, high in zip(
                    batch["conv"], batch["number"], batch["role"], batch["start"], batch["end"], batch["piece"],
                    batch["text_start"], batch["text_end"]):
                if number == 0:
                    if state:
                        done.append(_closed(conv, state))
                    conv, state = at, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for who, said in parse(piece):
                    state[0] += 1
                    state[1].update(f"{who}\n{said}\n".encode("utf-8", "surrogatepass"))
                if role in learn:
                    masked = unescape(piece[low - start:high - start])
                    state[2] += len(masked)
                    state[3].update(masked.encode("utf-8", "surrogatepass"))
                state[4] = end
            yield pd.DataFrame(done, columns=columns)
        if state:
            yield pd.DataFrame([_closed(conv, state)], columns=columns)

    columns = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    source = formatted.select(F.struct(F.col(key).alias("v")).alias("conv"), *[c for c in formatted.columns if c != key])
    result = source.mapInPandas(
        read, f"conv struct<v: {kind}>, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return result.select(F.col("conv.v").alias(key), *columns[1:])


def _closed(conv, state: list) -> tuple:
    return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
