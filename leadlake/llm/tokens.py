"""Token counts by a tokenizer compiled into a finite-state transducer.

A piece model with ranked merges is turned into a deterministic transducer: reading a character moves to the next
state and emits how many tokens the text now has more (or fewer, when tokens close up). A state holds what the future
can depend on: the longest suffix that may still grow into a piece, and for each position in it the last token of the
best split up to there. One token extends a split exactly if the two neighbours are stable under the model's own
merges, so the transition is decided without looking ahead. States and transitions are made when first met and shared.

Where no piece spans two neighbouring characters the state does not depend on what came before. Between two such
points a text is one macro transition, and a chunk of a text is a state map: a head that waits for the state it is
entered with, a count, and a tail that tells the state it leaves. Maps compose associatively, so chunks of long texts
are counted by different tasks and composed in order.

Defined results: a NULL or empty text has 0 tokens and 0 bytes; equal rows are counted one by one; a text of any
length is read in chunks; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
CHUNK_CHARS = 1 << 16
#: Memory bounds of one worker: macro transitions and states are dropped and made again beyond them.
MAX_MACROS = 400_000
MAX_STATES = 300_000


class PieceTransducer:
    """Counts the tokens of a sentencepiece model of ranked merges, with byte fallback for unknown characters."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        long_pieces = [p for p in scores if len(p) > 1]
        self.heads = {p[:i] for p in long_pieces for i in range(1, len(p))}
        self.joined = {p[i:i + 2] for p in long_pieces for i in range(len(p) - 1)}
        if any(pair[1] == BLANK != pair[0] for pair in self.joined) or any("\n" in pair for pair in self.joined):
            raise ValueError("a piece spans the start of a word or a line: words are no macro transitions of this model")
        self.segments = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n|[^{BLANK}\n]+")
        self.head = re.compile(f"{BLANK}*[^{BLANK}\n]*")
        self._stable: dict[tuple[str | None, str], bool] = {}
        self.macros: dict[str, int] = {}
        self._restart()

    def _restart(self) -> None:
        #: A state: (open suffix, last token at each position of it and before it, tokens up to there less tokens so far).
        self.states = [("", (None,), (0,))]
        self.ids = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    @staticmethod
    def _bytes_of(token: str) -> int:
        return len(token.encode("utf-8", "surrogatepass"))

    def _cost(self, token: str) -> int:
        return 1 if token in self.scores else self._bytes_of(token)

    def _merged(self, text: str) -> list[str]:
        """The model's own merging of a short text: the best pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _fits(self, before: str | None, token: str) -> bool:
        key = (before, token)
        known = self._stable.get(key)
        if known is None:
            if len(self._stable) > MAX_MACROS:
                self._stable.clear()
            known = self._merged((before or "") + token) == ([before, token] if before else [token])
            self._stable[key] = known
        return known

    def _move(self, state: int, char: str) -> tuple[int, int]:
        suffix, tokens, counts = self.states[state]
        grown = suffix + char
        for size in range(len(grown), 0, -1):
            token = grown[-size:]
            if (size == 1 or token in self.scores) and self._fits(tokens[-size], token):
                break
        else:
            raise AssertionError("every text has a split")
        emitted = counts[-size] + self._cost(token)
        keep = next(n for n in range(len(grown), -1, -1) if n == 0 or grown[-n:] in self.heads)
        if keep == 0:
            return 0, emitted
        all_tokens, all_counts = (*tokens, token), (*(c - emitted for c in counts), 0)
        kept_tokens, kept_counts = all_tokens[-keep - 1:], all_counts[-keep - 1:]
        if len(grown) > keep and grown[-keep - 1:-keep + 1 or None] not in self.joined:
            kept_tokens = (None, *kept_tokens[1:])  # nothing spans this place: what stood before it is forgotten
        key = (grown[-keep:], kept_tokens, kept_counts)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return self.ids[key], emitted

    def run(self, text: str) -> int:
        """Tokens of a text read from the first state."""
        state = total = 0
        for char in text:
            step = self.moves[state].get(char)
            if step is None:
                step = self.moves[state][char] = self._move(state, char)
            state, emitted = step
            total += emitted
        return total

    def _macro(self, segment: str) -> int:
        if len(self.states) >= MAX_STATES:
            self._restart()
        if len(self.macros) >= MAX_MACROS:
            self.macros.clear()
        n = self.run(segment)
        if len(segment) <= 64:
            self.macros[segment] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a stretch that begins and ends where the state does not matter."""
        total = 0
        for segment in self.segments.findall(text):
            n = self.macros.get(segment)
            total += self._macro(segment) if n is None else n
        return total

    def state_map(self, chunk: str, first: bool) -> tuple[str, int | None, str]:
        """(head, count, tail) of a chunk; count is None when the whole chunk is head."""
        text = chunk.replace(" ", BLANK)
        if first:
            head, rest = "", BLANK + text
        else:
            head = self.head.match(text).group()
            rest = text[len(head):]
            if not rest:
                return head, None, ""
        cut = max(rest.rfind("\n") + 1, len(rest.rstrip(BLANK)) if rest.endswith(BLANK) else 0)
        if not rest.endswith((BLANK, "\n")):
            cut = max(cut, self._last_word(rest, cut))
        return head, self.count(rest[:cut]), rest[cut:]

    @staticmethod
    def _last_word(rest: str, line: int) -> int:
        """Where the last run of blanks before the end starts."""
        last = rest.rfind(BLANK, line)
        while last > line and rest[last - 1] == BLANK:
            last -= 1
        return max(last, line)

    def compose(self, left: tuple[str, int | None, str], right: tuple[str, int | None, str]) -> tuple[str, int | None, str]:
        """The map of two adjacent chunks."""
        if right[1] is None:
            return (left[0] + right[0], None, "") if left[1] is None else (left[0], left[1], left[2] + right[0])
        if left[1] is None:
            return left[0] + right[0], right[1], right[2]
        return left[0], left[1] + self.count(left[2] + right[0]) + right[1], right[2]

    def scan(self, maps: list[tuple[str, int | None, str]]) -> tuple[str, int | None, str]:
        """All maps composed in order, by halves."""
        while len(maps) > 1:
            maps = [self.compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def close(self, whole: tuple[str, int | None, str]) -> int:
        """Tokens of a complete text from its map."""
        return whole[1] + self.count(whole[2])


@lru_cache(maxsize=2)
def load(model_path: str) -> PieceTransducer:
    """The transducer of a model file, once per worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    if any(model.is_unused(i) for i in plain):
        raise ValueError("models with unused pieces are not supported")
    return PieceTransducer({model.id_to_piece(i): model.get_score(i) for i in plain})


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The input's columns as struct ``row``, with ``n_bytes`` and ``n_tokens`` of its text column.

    ``model_path`` must name the same file on every executor. Rows are keyed by their place, so equal rows stay apart;
    only state maps are shuffled, never texts.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    pieces = F.when(F.length(body) <= chunk_chars, F.array(body)).otherwise(
        F.regexp_extract_all(body, F.lit(f"(?s).{{1,{chunk_chars}}}"), 0))
    keyed = docs.select(
        F.monotonically_increasing_id().alias("_id"), F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("row")
        if [c for c in docs.columns if c != text] else F.struct(F.lit(None).alias("none")).alias("row"),
        F.octet_length(body).cast("long").alias("n_bytes"), pieces.alias("_pieces"))
    # The key is made before the chunks are, so that all chunks of a row share it.
    keyed = keyed.select("_id", "row", "n_bytes", F.posexplode("_pieces").alias("_chunk", "_piece"))

    def to_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = load(model_path)
        for batch in batches:
            maps = [machine.state_map(p, n == 0) if p or n else ("", 0, "") for p, n in zip(batch["_piece"], batch["_chunk"])]
            yield pd.DataFrame({
                "_id": batch["_id"], "_chunk": batch["_chunk"], "_head": [m[0] for m in maps],
                "_synced": [m[1] is not None for m in maps], "_count": [m[1] or 0 for m in maps], "_tail": [m[2] for m in maps],
                "n_bytes": batch["n_bytes"], "row": batch["row"]})

    def to_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = load(model_path)
        for batch in batches:
            totals = [machine.close(machine.scan([(m["_head"], m["_count"] if m["_synced"] else None, m["_tail"]) for m in maps]))
                      for maps in batch["_maps"]]
            yield pd.DataFrame({"row": batch["row"], "n_bytes": batch["n_bytes"], "n_tokens": totals})

    row_type = keyed.schema["row"].dataType.simpleString()
    maps = keyed.mapInPandas(
        to_maps, f"_id long, _chunk int, _head string, _synced boolean, _count long, _tail string, n_bytes long, row {row_type}")
    gathered = maps.groupBy("_id").agg(
        F.first("row").alias("row"), F.first("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("_chunk", "_head", "_synced", "_count", "_tail"))).alias("_maps"))
    return gathered.select("row", "n_bytes", "_maps").mapInPandas(to_counts, f"row {row_type}, n_bytes long, n_tokens long")
