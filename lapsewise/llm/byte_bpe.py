"""Byte-level BPE as a lazily determinised finite-state transducer.

The BPE encoding of a text is the only sequence of tokens in which no merge would
cross a boundary between neighbours, and that sequence is built byte by byte: the
last token of a prefix is the one suffix of it that is compatible with the last
token before that suffix.  A boundary matters only as long as the bytes after it
begin some longer token.  A state of the transducer therefore holds the boundaries
that still matter with the tokens that lead to them, from the last boundary that
all of them share; a byte leads to a new state and emits the tokens up to its
shared boundary.  So tokens come out after a lookahead bounded by the longest token.
States are made when first reached and kept, up to a bound; at the bound those farthest
from the start go, since nearly all pieces pass those near it.

Decoding streams, too: a token takes an incremental UTF-8 automaton from the bytes of
an unfinished character to the next such bytes and emits the characters finished.

Defined results: a null or empty text has no ids and decodes to nothing; ill-formed
bytes of made-up id sequences decode to U+FFFD; rows that repeat are encoded alike;
columns other than doc_id and text (ids) are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import KEPT, map_arrow

NEVER = 1 << 60
START = -1  # "last token" of the boundary at which a piece begins
ROOT, NO_TOKEN = 0, -1
PAIR = 32  # bits of a token in the number of a pair
MOST_KNOWN = 300_000


class Merges:
    """Ranks compiled for one question: would a merge cross the boundary between two tokens?"""

    def __init__(self, content: bytes):
        pairs = (line.split() for line in content.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # Tokens as a trie: a node's child by a byte, the token that ends at a node, and whether longer ones go on.
        self.children: dict[int, int] = {}
        self.ending, self.longer = [NO_TOKEN], [True]
        for token, rank in self.ranks.items():
            node = ROOT
            for byte in token:
                self.longer[node] = True
                step = node << 8 | byte
                node = self.children.get(step, ROOT)
                if node == ROOT:
                    node = self.children[step] = len(self.ending)
                    self.ending.append(NO_TOKEN)
                    self.longer.append(False)
            self.ending[node] = rank
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self.known: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte or a token no merges make."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.tokens[token]]
            while len(parts) > 2:
                ranks = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                least = min(ranks)
                if least >= token:
                    break
                at = ranks.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = len(parts) == 2 and all(p in self.ranks for p in parts)
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if made else None
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int]]:
        """Tokens that stand at one end while ``token`` grows, each with the rank that ends it."""
        if token not in known:
            spine, until = [], NEVER
            at = token
            while True:
                spine.append((at, until))
                parts = self.halves(at) if len(self.tokens[at]) > 1 else None
                if parts is None:
                    break
                until, at = at, parts[side]
            known[token] = spine[::-1]
        return known[token]

    def apart(self, a: int, b: int) -> bool:
        """Whether ``b`` can follow ``a`` (or begin a piece, after START)."""
        if len(self.known) >= MOST_KNOWN:
            self.known.clear()
        found = self.known[a << PAIR | b] = self.reachable(b) and (a == START or not self._crosses(a, b))
        return found

    def _crosses(self, a: int, b: int) -> bool:
        """Merges go by rank, and from left to right within a rank: so at equal ranks a merge
        within ``a`` comes before one across the boundary, and that before one within ``b``."""
        ends, begins = self._edge(a, 1, self._right), self._edge(b, 0, self._left)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = ends[i], begins[j]
            across = self.ranks.get(self.tokens[x] + self.tokens[y], NEVER)
            if across < x_until and across <= y_until:
                return True
            if x_until == NEVER and y_until == NEVER:
                return False
            if x_until <= y_until:
                i += 1
            else:
                j += 1


class State:
    """The boundaries that still matter, the present end of the text last.

    Each is (trie node of the bytes after it, token before it, tokens from the shared boundary to it).
    """

    __slots__ = ("live", "next")

    def __init__(self, live: tuple[tuple[int, int, tuple[int, ...]], ...]):
        self.live = live
        self.next: dict[int, tuple[State, tuple[int, ...]]] = {}


class Encoder:
    """Encodes pieces; ``max_states`` and ``max_pieces`` bound what is kept between them."""

    def __init__(self, content: bytes, pattern: str, max_states: int = 250_000, max_pieces: int = 200_000):
        self.merges = Merges(content)
        self.pieces = regex.compile(pattern).findall
        self.max_states, self.max_pieces = max_states, max_pieces
        # Pieces met lately and those met before; the former take over when full.
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.start = State(((ROOT, START, ()),))
        self.states = {self.start.live: self.start}

    def _prune(self) -> None:
        """Keeps the half of the states that is nearest to the start."""
        near = [self.start]
        kept = {self.start.live: self.start}
        for state in near:
            for byte, (to, _) in list(state.next.items()):
                if kept.get(to.live) is not to:
                    if 2 * len(near) >= self.max_states:
                        del state.next[byte]
                        continue
                    kept[to.live] = to
                    near.append(to)
        self.states = kept

    def _step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        merges, end, live = self.merges, None, []
        children, ending, longer, known = merges.children, merges.ending, merges.longer, merges.known
        for node, before, way in state.live:
            node = children.get(node << 8 | byte)
            if node is None:
                continue
            if end is None and (token := ending[node]) >= 0:
                apart = known.get(before << PAIR | token)
                if merges.apart(before, token) if apart is None else apart:
                    end = (ROOT, token, (*way, token))
            if longer[node]:
                live.append((node, before, way))
        live.append(end)
        # What all ways share is certain.
        first, shared = live[0][2], 0
        for token in first:
            for _, _, way in live:
                if len(way) <= shared or way[shared] != token:
                    break
            else:
                shared += 1
                continue
            break
        if shared:
            live = [(node, before, way[shared:]) for node, before, way in live]
        key = tuple(live)
        to = self.states.get(key)
        if to is None:
            if len(self.states) >= self.max_states:
                self._prune()
            to = self.states[key] = State(key)
        step = state.next[byte] = to, first[:shared]
        return step

    def piece(self, data: bytes) -> tuple[int, ...]:
        whole = self.merges.ranks.get(data)
        if whole is not None:
            return (whole,)
        state, out = self.start, []
        for byte in data:
            step = state.next.get(byte)
            state, made = self._step(state, byte) if step is None else step
            if made:
                out += made
        return (*out, *state.live[-1][2])

    def _new(self, piece: str) -> tuple[int, ...]:
        ids = self.known.get(piece) or self.older.get(piece)
        if ids is None:
            ids = self.piece(piece.encode())
            if len(piece) > 64:  # too long to come back
                return ids
        if len(self.known) >= self.max_pieces:
            self.older, self.known = self.known, {}
        self.known[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        pieces = self.pieces(text)
        parts = list(map(self.known.get, pieces))
        if None in parts:
            parts = [self._new(piece) if ids is None else ids for piece, ids in zip(pieces, parts)]
        return np.fromiter(chain.from_iterable(parts), np.int32)


# -- decoding -------------------------------------------------------------------------

#: Fixed values, Unicode table 3-7: lead bytes, range of the second byte, length of the character.
UTF8_LEADS = (
    (0x00, 0x7F, 0x00, 0x00, 1),
    (0xC2, 0xDF, 0x80, 0xBF, 2),
    (0xE0, 0xE0, 0xA0, 0xBF, 3),
    (0xE1, 0xEC, 0x80, 0xBF, 3),
    (0xED, 0xED, 0x80, 0x9F, 3),
    (0xEE, 0xEF, 0x80, 0xBF, 3),
    (0xF0, 0xF0, 0x90, 0xBF, 4),
    (0xF1, 0xF3, 0x80, 0xBF, 4),
    (0xF4, 0xF4, 0x80, 0x8F, 4),
)
_LEAD = {b: (low, high, n) for first, to, low, high, n in UTF8_LEADS for b in range(first, to + 1)}
REPLACEMENT = "�"


def advance(held: bytes, data: bytes) -> tuple[str, bytes]:
    """Characters finished by ``data`` after the unfinished bytes ``held``, and what is unfinished then."""
    data, out, at = held + data, [], 0
    while at < len(data):
        lead = _LEAD.get(data[at])
        if lead is None:
            out.append(REPLACEMENT)
            at += 1
            continue
        low, high, n = lead
        good = 1
        while good < n and at + good < len(data):
            if not (low if good == 1 else 0x80) <= data[at + good] <= (high if good == 1 else 0xBF):
                break
            good += 1
        if good == n:
            out.append(data[at : at + n].decode())
        elif at + good == len(data):
            return "".join(out), data[at:]
        else:
            out.append(REPLACEMENT)
        at += good
    return "".join(out), b""


class Decoder:
    """The automaton's steps by unfinished bytes and token, made when first taken."""

    def __init__(self, tokens: dict[int, bytes], max_steps: int = 300_000):
        self.tokens, self.max_steps = tokens, max_steps
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        self.n_steps = 0

    def _step(self, held: bytes, token: int) -> tuple[str, bytes]:
        if self.n_steps >= self.max_steps:
            self.steps, self.n_steps = {b"": {}}, 0
        self.n_steps += 1
        made = self.steps.setdefault(held, {})[token] = advance(held, self.tokens[token])
        return made

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as it becomes complete; what is unfinished at the end is one U+FFFD."""
        held, steps = b"", self.steps.setdefault(b"", {})
        for token in ids:
            step = steps.get(token)
            text, now = self._step(held, token) if step is None else step
            if now != held or step is None:
                held, steps = now, self.steps.setdefault(now, {})
            if text:
                yield text
        if held:
            yield REPLACEMENT

    def decode(self, ids: Iterable[int]) -> bytes:
        return "".join(self.stream(ids)).encode()


@lru_cache(maxsize=2)
def coders(content: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """One pair a worker process; the bounds hold for all its tasks together, until it works for another operator."""
    encoder = Encoder(content, pattern)
    return encoder, Decoder(encoder.merges.tokens)


KEPT[__name__] = (lambda: coders.cache_info().currsize, coders.cache_clear)


# -- on Spark ---------------------------------------------------------------------------


def _vocabulary(df: DataFrame, path: str | None):
    """The rank file, read on the driver and sent once to each executor (under a megabyte)."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def encode(documents: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and ids of every row."""
    content = _vocabulary(documents, path)

    def rows(batch: pa.RecordBatch) -> dict:
        encoder, _ = coders(content.value, pattern)
        return {"doc_id": batch.column("doc_id"), "ids": _lists([encoder.encode(t) for t in _texts(batch)])}

    source = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(source, rows, "doc_id long, ids array<int>", 4 << 20, __name__)


def decode(tokens: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and decoded (UTF-8 bytes) of every row of ids."""
    content = _vocabulary(tokens, path)

    def rows(batch: pa.RecordBatch) -> dict:
        _, decoder = coders(content.value, pattern)
        decoded = [decoder.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "decoded": pa.array(decoded, pa.binary())}

    return map_arrow(tokens.select("doc_id", "ids"), rows, "doc_id long, decoded binary", 4 << 20, __name__)


def round_trip(documents: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids and what they decode to, in one pass over the texts."""
    content = _vocabulary(documents, path)

    def rows(batch: pa.RecordBatch) -> dict:
        encoder, decoder = coders(content.value, pattern)
        ids = [encoder.encode(t) for t in _texts(batch)]
        decoded = [decoder.decode(x.tolist()) for x in ids]
        return {"doc_id": batch.column("doc_id"), "ids": _lists(ids), "decoded": pa.array(decoded, pa.binary())}

    source = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(source, rows, "doc_id long, ids array<int>, decoded binary", 4 << 20, __name__)


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``round_trip``'s rows."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
