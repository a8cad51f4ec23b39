"""Byte-level BPE with vectorised pre-tokenisation and cached, vectorised pair merging.

Texts are code point arrays; a table gives every code point its class. Where a slice ends
depends on what the pattern's matcher is doing, which a small automaton tracks: a transition
function per class, composed associatively. The functions of one column of a matrix of code
points are composed for all rows at once, then over the rows, so the automaton's state is
known at every code point without a regular expression or a loop over characters.

Slices that were merged before come from a cache. The others are merged together: every
round looks up the ranks of all neighbouring pairs and merges the lowest, leftmost pair of
every slice, as the rank file's merge order demands. Token offsets are kept beside the ids,
so decoding gathers each document's bytes in one step.

Null and empty texts have no ids. Repeated rows give repeated results; extra columns stay.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rookery.llm.batches import binary_lists, freeing, slices, small_batches, text_bytes

# --- pre-tokenisation -------------------------------------------------------

# Classes of code points. PAIRED are the letters that end a contraction at once ('s 't 'm 'd),
# TRIPLE the first of two that do ('re 've 'll), known by looking one ahead.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, PAIRED, TRIPLE = range(8)
CLASSES = 8
# States: at a fresh start, behind a blank that joins what follows, inside a run, behind a
# quote that opened a slice, behind the first of a contraction's two letters.
FRESH, JOIN, LETTERS, NUMBERS, OTHERS, QUOTED, HALF = range(7)
STATES = 7


def _class_table() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        table[code] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    # Unicode's white space: controls, spaces and separators.
    white = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029]
    table[[*white, 0x202F, 0x205F, 0x3000]] = SPACE
    table[0x20] = BLANK
    table[ord("'")] = QUOTE
    return table


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a slice starts, by class and state.

    The second half of the classes stands for the first character of a text. Starts in white
    space depend on the run's end and are set elsewhere.
    """
    step = np.zeros((2 * CLASSES, STATES), np.uint8)
    opens = np.ones((2 * CLASSES, STATES), bool)
    step[[SPACE]] = FRESH
    step[[BLANK]] = JOIN
    for kind, run in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS)):
        step[kind] = run
        opens[kind, [JOIN, run]] = False
    step[QUOTE] = QUOTED
    for kind in (OTHER, QUOTE):  # a quote inside a run of others is one of them
        step[kind, [JOIN, OTHERS, QUOTED]] = OTHERS
        opens[kind, [JOIN, OTHERS, QUOTED]] = False
    step[[PAIRED, TRIPLE]], opens[[PAIRED, TRIPLE]] = step[LETTER], opens[LETTER]
    step[PAIRED, QUOTED], step[TRIPLE, QUOTED] = FRESH, HALF
    opens[[PAIRED, TRIPLE], QUOTED] = False
    step[[LETTER, PAIRED, TRIPLE], HALF] = FRESH
    opens[[LETTER, PAIRED, TRIPLE], HALF] = False
    step[CLASSES:] = step[:CLASSES, [FRESH]]
    opens[CLASSES:] = True
    return step, opens


_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if not _tables:
        _tables["class"] = _class_table()
        step, opens = _automaton()
        _tables["step"], _tables["opens"] = step.ravel(), opens.ravel()
    return _tables[name]


def _states(kinds: np.ndarray, width: int = 256) -> np.ndarray:
    """The automaton's state before every character.

    Rows of ``width`` characters are reduced to one transition function each, column by
    column for all rows; the functions are composed over the rows, and each row is then run
    from its known state.
    """
    step = _table("step")
    rows = -(-len(kinds) // width)
    padded = np.zeros(rows * width, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, width).T) * np.uint8(STATES)
    functions = np.tile(np.arange(STATES, dtype=np.uint8)[:, None], (1, rows))
    for column in columns:
        functions = step[column + functions]
    state, entered = FRESH, np.zeros(rows, np.uint8)
    for row, function in enumerate(functions.T.tolist()):
        entered[row] = state
        state = function[state]
    out = np.empty((width, rows), np.uint8)
    for number, column in enumerate(columns):
        out[number] = entered
        entered = step[column + entered]
    return out.T.ravel()[: len(kinds)]


def slice_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where slices start in code points of several texts; ``first`` has each text's start."""
    if not len(codes):
        return np.zeros(0, bool)
    kinds = _table("class")[codes]
    begins = np.zeros(len(codes) + 1, bool)
    begins[first] = True
    begins[-1] = True
    follows = np.zeros(len(codes), np.uint32)
    follows[:-1] = codes[1:]
    follows[begins[1:]] = 0
    pair = np.isin(codes, [ord(c) for c in "stmd"])
    triple = ((codes == ord("r")) | (codes == ord("v"))) & (follows == ord("e"))
    triple |= (codes == ord("l")) & (follows == ord("l"))
    kinds[pair], kinds[triple] = PAIRED, TRIPLE
    white = (kinds == SPACE) | (kinds == BLANK)
    inner = np.zeros(len(codes), bool)  # white space before more of it, or before a text's end
    inner[:-1] = white[1:]
    inner[begins[1:]] = True
    previous = np.zeros(len(codes), bool)
    previous[1:] = white[:-1]
    previous[begins[:-1]] = False
    kinds[begins[:-1]] += CLASSES
    states = _states(kinds)
    opens = _table("opens")[kinds.astype(np.int64) * STATES + states]
    return np.where(white, ~previous | ~inner, opens)


# --- merging ----------------------------------------------------------------


@dataclass
class Vocabulary:
    """A rank file's tokens, and which pairs of them merge into which."""

    tokens: list[bytes]
    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    byte_ids: np.ndarray
    keys: np.ndarray
    merged: np.ndarray

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        ranks = {}
        for line in content.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        tokens = [b""] * (max(ranks.values()) + 1)
        pairs = {}
        for token, rank in ranks.items():
            tokens[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        lengths = np.array([len(token) for token in tokens], np.int64)
        return cls(
            tokens,
            np.frombuffer(b"".join(tokens), np.uint8),
            np.cumsum(lengths) - lengths,
            lengths,
            np.array([ranks[bytes([b])] for b in range(256)], np.int64),
            keys,
            np.array([pairs[key] for key in keys.tolist()], np.int64),
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges into; ``_NONE`` where it does not."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of every piece."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        sizes = np.array([len(piece) for piece in pieces])
        order = np.argsort(sizes, kind="stable")
        begin = 0
        while begin < len(order):
            width = int(sizes[order[begin]])
            if width > _WIDE:
                out[order[begin]] = self._merge_long(pieces[order[begin]])
                begin += 1
                continue
            most = max(1, _CELLS // max(1, width))
            end = min(int(np.searchsorted(sizes[order], width, "right")), begin + most)
            group = order[begin:end]
            raw = np.frombuffer(b"".join([pieces[i] for i in group]), np.uint8)
            ids, counts = self._merge_equal(self.byte_ids[raw].reshape(len(group), width))
            for i, row, count in zip(group.tolist(), ids, counts.tolist()):
                out[i] = row[:count]
            begin = end
        return out

    def _merge_equal(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of one length, one pair per piece and round."""
        count, width = ids.shape
        done, lengths = np.zeros(ids.shape, np.uint32), np.full(count, width)
        if width < 2:
            return ids.astype(np.uint32), lengths
        ids = np.pad(ids, ((0, 0), (0, 1)))
        ranks = np.full(ids.shape, _NONE)
        ranks[:, : width - 1] = self.rank(ids[:, : width - 1], ids[:, 1:width])
        places = np.arange(count)
        columns = np.arange(width)
        while len(places):
            best = ranks.argmin(axis=1)
            rows = np.arange(len(places))
            token = ranks[rows, best]
            stop = token == _NONE
            if stop.any():
                done[places[stop]] = ids[stop, :width]
                go = ~stop
                places, ids, ranks, best, token = (
                    x[go] for x in (places, ids, ranks, best, token)
                )
                if not len(places):
                    break
                rows = np.arange(len(places))
            behind = columns[None, :] > best[:, None]
            ids[:, :width] = np.where(behind, ids[:, 1:], ids[:, :width])
            ranks[:, :width] = np.where(behind, ranks[:, 1:], ranks[:, :width])
            ids[rows, best] = token
            lengths[places] -= 1
            size = lengths[places]
            right = best < size - 1
            ranks[rows, best] = _NONE
            ranks[rows[right], best[right]] = self.rank(
                token[right], ids[rows[right], best[right] + 1]
            )
            left = best > 0
            ranks[rows[left], best[left] - 1] = self.rank(
                ids[rows[left], best[left] - 1], token[left]
            )
        return done, lengths

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Merge one long piece with a heap of pairs over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        if not _known:
            _known.update(zip(self.keys.tolist(), self.merged.tolist()))
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap = []

        def offer(at: int) -> None:
            other = after[at]
            if other < len(ids):
                rank = _known.get(ids[at] << 32 | ids[other])
                if rank is not None:
                    heapq.heappush(heap, (rank, at, ids[at], ids[other]))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            other = after[at] if ids[at] == left else len(ids)
            if other >= len(ids) or ids[other] != right:
                continue
            ids[at], ids[other] = rank, -1
            after[at] = after[other]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return np.array([i for i in ids if i >= 0], np.uint32)


_NONE = np.int64(2**62)
_WIDE = 96  # bytes from which a piece is merged on its own
_CELLS = 1 << 18
_CACHE = 200_000  # pieces a worker remembers
_known: dict[int, int] = {}
_loaded: dict[int, tuple[Vocabulary, dict[bytes, bytes]]] = {}


def _vocabulary(content: bytes) -> tuple[Vocabulary, dict[bytes, bytes]]:
    """The parsed rank file and the cache that belongs to it, kept in the worker."""
    key = hash(content)
    if key not in _loaded:
        _loaded.clear()
        _known.clear()
        _loaded[key] = (Vocabulary.parse(content), {})
    return _loaded[key]


# --- encoding and decoding --------------------------------------------------


def pieces_of(texts: pa.Array) -> tuple[list[bytes], list[int]]:
    """All slices of all texts in a row, and each text's first one (one more at the end)."""
    data, offsets = text_bytes(texts)
    raw = data.tobytes()
    codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(leads, offsets)
    starts = leads[np.flatnonzero(slice_starts(codes, first[:-1][np.diff(first) > 0]))]
    cuts = starts.tolist()
    cuts.append(len(raw))
    pieces = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
    return pieces, np.searchsorted(starts, offsets).tolist()


def encode_texts(texts: pa.Array, content: bytes) -> list[bytes]:
    """The ids of every text, as little-endian unsigned 32-bit integers."""
    vocabulary, cache = _vocabulary(content)
    pieces, bounds = pieces_of(texts)
    fresh = list({piece for piece in pieces if piece not in cache})
    if len(cache) + len(fresh) > _CACHE:
        cache.clear()
        fresh = list(set(pieces))
    for piece, ids in zip(fresh, vocabulary.merge(fresh)):
        cache[piece] = ids.astype("<u4").tobytes()
    found = [cache[piece] for piece in pieces]
    return [b"".join(found[a:b]) for a, b in zip(bounds, bounds[1:])]


def decode_ids(ids: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The bytes of a run of ids; ``lengths`` are the tokens' byte lengths."""
    ends = np.cumsum(lengths)
    source = np.arange(ends[-1] if len(ends) else 0)
    source += np.repeat(vocabulary.starts[ids] - (ends - lengths), lengths)
    return vocabulary.flat[source]


def encode(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns plus ids (uint32, little-endian) and token_bytes (each token's length).

    ``path`` is the rank file, read on the driver and broadcast. Columns of these names are
    replaced.
    """
    with open(path, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    small_batches(documents.sparkSession)
    own = documents.drop("ids", "token_bytes")
    # a text that stays in the result is sent to the worker once
    source, extra = (text, []) if text in own.columns else ("_text", ["_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _vocabulary(shared.value)
        widths = np.minimum(vocabulary.lengths, 255).astype(np.uint8)
        for batch in slices(batches, source):
            ids = encode_texts(batch.column(source), shared.value)
            lengths = [widths[np.frombuffer(one, "<u4")].tobytes() for one in ids]
            yield (
                batch.drop_columns(extra)
                .append_column("ids", pa.array(ids, pa.binary()))
                .append_column("token_bytes", pa.array(lengths, pa.binary()))
            )

    base = documents.withColumn("_text", F.col(text)).drop("ids", "token_bytes") if extra else own
    schema = base.drop(*extra).schema.add("ids", "binary").add("token_bytes", "binary")
    return base.mapInArrow(freeing(run), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns but ids and token_bytes, plus ``decoded`` (bytes).

    ``encoded`` has ids as ``encode`` returns them; its token_bytes place every token's bytes.
    """
    with open(path, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _vocabulary(shared.value)
        for batch in slices(batches, "ids", 1 << 20):
            data, offsets = text_bytes(batch.column("ids"))
            ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
            lengths = text_bytes(batch.column("token_bytes"))[0].astype(np.int64)
            wide = lengths == 255  # a length that does not fit a byte is looked up
            lengths[wide] = vocabulary.lengths[ids[wide]]
            out = decode_ids(ids, lengths, vocabulary)
            ends = np.concatenate([[0], np.cumsum(lengths)])[offsets // 4]
            yield batch.drop_columns(["ids", "token_bytes"]).append_column(
                "decoded", binary_lists(out, ends)
            )

    base = encoded.drop("decoded")
    schema = base.drop("ids", "token_bytes").schema.add("decoded", "binary")
    return base.mapInArrow(freeing(run), schema)
