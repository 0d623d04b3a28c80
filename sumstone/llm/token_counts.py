"""Token counts by a finite-state transducer compiled from a byte-pair vocabulary.

A sequence of pieces is what the tokenizer gives exactly if each piece encodes to itself and each two
neighbours encode to themselves: the first merge across a border would also happen in the text of
the two pieces alone.  So the last piece of every prefix of a text follows from the last pieces of
shorter prefixes.  A state holds what is needed for that: each open start of a piece (its node in
the tree of pieces), the piece before it, and how many more tokens it stands at than the lowest one.
Reading a character leads to one next state and emits the tokens by which the lowest count grew; a
final weight adds what the last piece stands above it.  States are compiled when first met.

Neighbouring characters that stand side by side in no piece end a segment, and the machine starts
anew.  Segments are cut into chunks, and all chunks of a slice of text advance together, one
character a step.  A chunk that does not begin a segment takes its entry state from the characters
before it; the maps (entry state to exit state and tokens) are composed by a prefix scan, and chunks
whose entry state was another run again with the right one, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm.common import worker_state

#: Characters that advance together, of a chunk, and read ahead of a chunk for its entry state.
SLICE, CHUNK, AHEAD = 1 << 19, 96, 32
#: States kept before the machine is compiled anew.
MOST_STATES = 400_000

_SPACE, _MARK = " ", "▁"
_CLASS_BITS = 13
_NEVER = float("inf")


class Transducer:
    """The machine of one vocabulary: character classes, pieces and the states met so far."""

    def __init__(self, pieces: dict[str, float], marked_start: bool = True) -> None:
        """``pieces`` with their order of merging, lowest first; equal ones merge from the left."""
        self.rank = pieces
        self.marked_start = marked_start
        letters = sorted({c for piece in pieces for c in piece})
        if len(letters) + 5 >= 1 << _CLASS_BITS:
            raise ValueError("too many different characters in the vocabulary")
        # Classes 1 to 4: characters in no piece, by their length in UTF-8; a token for each byte.
        codes = np.arange(0x110000)
        self.classes = np.digitize(codes, [0, 0x80, 0x800, 0x10000]).astype(np.int16)
        number = {c: i + 5 for i, c in enumerate(letters)}
        for c, i in number.items():
            self.classes[ord(c)] = i
        if _MARK in number:
            self.classes[ord(_SPACE)] = number[_MARK]
        n = len(letters) + 5
        self.joinable = np.zeros((n, n), bool)
        self.kids: list[dict[int, int]] = [{}]
        self.piece: list[str | None] = [None]
        self.weight: list[int] = [0]
        for k in (1, 2, 3, 4):
            self._add([k], None, k)
        for c, i in number.items():
            self._add([i], c, 1 if c in pieces else len(c.encode()))
        for piece in pieces:
            path = [number[c] for c in piece]
            self.joinable[path[:-1], path[1:]] = True
            self._add(path, piece, 1 if len(path) > 1 or piece in pieces else self.weight[path[0]])
        self.steps: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.restart()

    def _add(self, path: list[int], piece: str | None, weight: int) -> None:
        node = 0
        for c in path:
            if c not in self.kids[node]:
                self.kids[node][c] = len(self.kids)
                self.kids.append({})
                self.piece.append(None)
                self.weight.append(0)
            node = self.kids[node][c]
        self.piece[node], self.weight[node] = piece, weight

    # ---- which pieces stand side by side

    def derivation(self, piece: str) -> tuple | None:
        """Merges that build ``piece`` in their order, with its outer symbols; None if none do."""
        if piece not in self.steps:
            rank, symbols = self.rank, list(piece)
            order, firsts, lasts = [], [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                costs = [rank.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
                low = min(costs)
                if low == _NEVER:
                    break
                at = costs.index(low)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                order.append(low)
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            self.steps[piece] = (order, firsts, lasts) if len(symbols) == 1 else None
        return self.steps[piece]

    def neighbours(self, a: str, b: str) -> bool:
        """True if no merge crosses the border when ``a`` and ``b`` are built side by side."""
        known = self.pairs.get((a, b))
        if known is None:
            left, _, lasts = self.derivation(a)
            right, firsts, _ = self.derivation(b)
            i = j = 0
            while True:
                across = self.rank.get(lasts[i] + firsts[j], _NEVER)
                own = left[i] if i < len(left) else _NEVER
                other = right[j] if j < len(right) else _NEVER
                if own <= across and own <= other and own < _NEVER:
                    i += 1
                elif across <= other and across < _NEVER:
                    known = False
                    break
                elif other < _NEVER:
                    j += 1
                else:
                    known = True
                    break
            self.pairs[a, b] = known
        return known

    # ---- states and transitions

    def restart(self) -> None:
        """Forget all states but the first."""
        first = ((0, None, 0),)
        self.states = [first]
        self.numbers = {first: 0}
        self.finals = np.zeros(1 << 10, np.int64)
        self.keys = np.zeros(1 << 16, np.int64)
        self.values = np.zeros(1 << 16, np.int64)
        self.filled = 0
        self.pairs.clear()

    def crowded(self) -> bool:
        """True if the machine should be compiled anew; a slice adds a transition a character at most."""
        return len(self.states) > MOST_STATES or self.filled > 8 * MOST_STATES

    def _compile(self, state: int, c: int) -> int:
        """The transition of a state by a class: next state and emitted tokens in one number."""
        open_, found = [], None
        for node, before, above in self.states[state]:
            child = self.kids[node].get(c)
            if child is None:
                continue
            if found is None and self.weight[child]:
                piece = self.piece[child]
                if piece is None or (
                    self.derivation(piece) is not None
                    and (before is None or self.neighbours(before, piece))
                ):
                    found = piece, above + self.weight[child]
            if self.kids[child]:
                open_.append((child, before, above))
        open_.append((0, *found))
        low = min(above for _, _, above in open_)
        reached = tuple((node, before, above - low) for node, before, above in open_)
        number = self.numbers.get(reached)
        if number is None:
            number = self.numbers[reached] = len(self.states)
            self.states.append(reached)
            if number == len(self.finals):
                self.finals = np.concatenate([self.finals, np.zeros_like(self.finals)])
            self.finals[number] = reached[-1][2]
        return number << 8 | low

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & (len(self.keys) - 1)

    def _store(self, keys: np.ndarray, values: np.ndarray) -> None:
        if 3 * (self.filled + len(keys)) > len(self.keys):
            used = self.keys > 0
            keys, values = np.append(self.keys[used], keys), np.append(self.values[used], values)
            size = len(self.keys)
            while 3 * len(keys) > size:
                size *= 4
            if size > 1 << 24:
                raise MemoryError("more transitions in one slice than the table holds")
            self.keys, self.values = np.zeros(size, np.int64), np.zeros(size, np.int64)
            self.filled = 0
        self.filled += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = keys[free]  # of several keys for one slot the last stays
            stays = self.keys[slots] == keys
            self.values[slots[stays]] = values[stays]
            keys, values, slots = keys[~stays], values[~stays], (slots[~stays] + 1) & (len(self.keys) - 1)

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys, -1 for unknown ones."""
        slots = self._slots(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.values[slots], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[slots[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (seen != 0)]
        return out

    def advance(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens; unknown transitions are compiled."""
        keys = states << _CLASS_BITS | classes
        told = self._look_up(keys)
        missing = told < 0
        if missing.any():
            new = np.unique(keys[missing])
            self._store(
                new,
                np.array([self._compile(k >> _CLASS_BITS, k & ((1 << _CLASS_BITS) - 1)) for k in new.tolist()]),
            )
            told[missing] = self._look_up(keys[missing])
        return told >> 8, told & 255

    def run(
        self, classes: np.ndarray, lo: np.ndarray, hi: np.ndarray, entry: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and emitted tokens of the ranges ``lo`` to ``hi``, all in step."""
        order = np.argsort(lo - hi, kind="stable")
        start, length = lo[order], (hi - lo)[order]
        state, emitted = entry[order].copy(), np.zeros(len(lo), np.int64)
        left = len(lo)
        for step in range(int(length[0]) if len(lo) else 0):
            left = int(np.searchsorted(-length[:left], -step, "left"))  # those longer than step
            state[:left], more = self.advance(state[:left], classes[start[:left] + step])
            emitted[:left] += more
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], emitted[back]

    def segments(
        self, classes: np.ndarray, heads: np.ndarray, entry: int = 0
    ) -> tuple[np.ndarray, int]:
        """Tokens of each segment, and the exit state of the last; the first begins in ``entry``."""
        ends = np.append(heads[1:], len(classes))
        parts = -((heads - ends) // CHUNK)
        first = np.cumsum(parts) - parts
        segment = np.repeat(np.arange(len(heads)), parts)
        lo = heads[segment] + (np.arange(len(segment)) - first[segment]) * CHUNK
        hi = np.minimum(lo + CHUNK, ends[segment])
        inner = np.ones(len(lo), bool)
        inner[first] = False
        state = np.zeros(len(lo), np.int64)
        state[0] = entry
        guess = np.flatnonzero(inner)
        if len(guess):
            state[guess] = self.run(classes, lo[guess] - AHEAD, lo[guess], np.zeros(len(guess), np.int64))[0]
        out, emitted = self.run(classes, lo, hi, state)
        while len(guess):
            # Scan: a chunk's map composes with the one before if that leaves where this one enters.
            guess = guess[out[guess - 1] != state[guess]]
            state[guess] = out[guess - 1]
            out[guess], emitted[guess] = self.run(classes, lo[guess], hi[guess], state[guess])
            guess = np.union1d(guess, guess[guess + 1 < len(lo)] + 1)
            guess = guess[inner[guess]]
        last = np.append(first[1:], len(lo)) - 1
        return np.add.reduceat(emitted, first) + self.finals[out[last]], int(out[last[-1]])

    def heads(self, classes: np.ndarray) -> np.ndarray:
        """Where segments begin: at 0 and between characters that no piece joins."""
        apart = ~self.joinable[classes[:-1], classes[1:]]
        return np.concatenate([[0], np.flatnonzero(apart) + 1])

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of short texts, which are taken together."""
        mark = _SPACE if self.marked_start else ""
        texts = [mark + t if t else t for t in texts]
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros(len(texts), np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            if self.crowded():
                self.restart()
            starts = (np.cumsum(sizes) - sizes)[full]
            classes = self.read("".join(texts))
            heads = np.union1d(self.heads(classes), starts)
            told, _ = self.segments(classes, heads)
            out[full] = np.add.reduceat(told, np.searchsorted(heads, starts))
        return out

    def count_long(self, text: str) -> int:
        """Tokens of a text of any length, a slice at a time; the state goes from slice to slice."""
        total, state, before = 0, 0, None
        for at in range(0, len(text), SLICE):
            part = text[at : at + SLICE]
            if at == 0 and self.marked_start:
                part = _SPACE + part
            classes = self.read(part)
            if before is not None and not self.joinable[before, classes[0]]:
                state = 0
            elif before is not None:
                total -= int(self.finals[state])  # the last segment goes on
            if self.crowded():
                kept = self.states[state]
                self.restart()
                state = self.numbers.setdefault(kept, len(self.states))
                if state:
                    self.states.append(kept)
                    self.finals[state] = kept[-1][2]
            told, state = self.segments(classes, self.heads(classes), state)
            total += int(told.sum())
            before = classes[-1]
        return total

    def read(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.classes[codes].astype(np.int64)


def compile_pieces(path: str) -> Transducer:
    """The transducer of a sentencepiece file of byte-pair pieces with byte fallback."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    told = "".join(model.encode("  ½ a  ﬁ. ", out_type=str))
    if told not in ("▁▁▁½▁a▁▁ﬁ.▁", "▁▁½▁a▁▁ﬁ.▁"):
        raise ValueError("the file normalizes texts, which the transducer does not")
    marked = told.startswith("▁▁▁")
    return Transducer({model.id_to_piece(i): -model.get_score(i) for i in ids}, marked)


def open_transducer(path: str) -> Transducer:
    """The transducer of a file, compiled once a worker."""
    state = worker_state("transducer", large=True)
    if path not in state:
        state.clear()
        state[path] = compile_pieces(path)
    return state[path]


def count_tokens(
    docs: DataFrame, text: str, model: str, carried: list[str], name: str = "n_tokens"
) -> DataFrame:
    """``carried`` columns of each row and the number of tokens of its whole ``text``.

    ``model`` is a sentencepiece file (byte-pair pieces, byte fallback, no normalization) that every
    executor can open.  Begin and end ids are not counted; strings of control pieces in a text are
    ordinary text.  A null or empty text has no tokens; a text of any length is read in slices, so
    memory is bounded by a batch of rows; repeated rows are counted once each, and an empty table
    gives an empty result.  Rows do not move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            machine = open_transducer(model)
            out = np.zeros(len(batch), np.int64)
            held: list[str] = []
            rows: list[int] = []
            size = 0

            def flush() -> None:
                nonlocal size
                out[rows] = machine.count(held)
                held.clear()
                rows.clear()
                size = 0

            column = batch.column("_text")
            for row in range(len(batch)):
                value = column[row].as_py() or ""
                if len(value) >= SLICE:
                    out[row] = machine.count_long(value)
                    continue
                held.append(value)
                rows.append(row)
                size += len(value) + 1
                if size >= SLICE:
                    flush()
            flush()
            columns = [batch.column(f"_{i}") for i in range(len(carried))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out)], [*carried, name])

    given = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carried)], F.col(text).alias("_text"))
    schema = StructType([docs.schema[c] for c in carried]).add(name, "long")
    return given.mapInArrow(run, schema)
