"""Two tokenizers side by side: groups of tokens over the same bytes, and counts of linked ids.

Texts are cut where neither tokenizer joins anything: before a space between two visible characters,
and around single line ends.  Each unit is encoded and aligned once while a worker keeps it.  A first
pass tallies the linked id pairs of each task; the distinct pairs get a minimal perfect hash, under
which the tallies become dense vectors that are summed in a tree.  The second pass aligns the
documents again and looks the counts of their links up.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm.common import freeze, give_back, row_ranges, worker_state
from sumstone.llm.pair_table import PARTS, PartFiles, with_sums, write_hashes, write_parts
from sumstone.llm.tokens import _byte_letters, open_tokenizer

#: Units and characters of them that a worker keeps, and bytes of text taken together.
KEPT, KEPT_LETTERS = 300_000, 4_000_000
_TEXT = 1 << 20
#: Pairs that a task holds before equal ones are added.
_PAIRS = 4_000_000

_MARK = "▁"
#: White space, or the mark that stands for it, beside a space or a line end; or a byte 0.
_UNCLEAR = re.compile(r"[\s▁] |[ \n][\s▁]|[\s▁]\n| $|\0")
_DOUBTFUL = ("  ", " \n", "\n ", "\n\n", _MARK)
_CUT = re.compile(r"(?<=[^\s▁])(?= [^\s▁])")
PAIR = np.int64(1) << np.int64(32)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places from each start on, as many as its size."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Aligner:
    """Both tokenizers, and the units met so far with their tokens, groups and links."""

    def __init__(self, first: str, second: str, counts: PartFiles | None = None) -> None:
        from sentencepiece import SentencePieceProcessor

        self.first = open_tokenizer(first)
        self.second = SentencePieceProcessor(model_file=second)
        self.counts = counts
        letters = {c: b for b, c in _byte_letters().items()}
        letters |= {chr(b): b for b in range(256) if chr(b) not in letters and b not in _byte_letters()}
        vocabulary = self.first["tokenizer"].get_vocab()
        self.first_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            known = all(c in letters for c in piece)
            self.first_bytes[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        self.second_bytes = []
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        for i, piece in enumerate(pieces):
            told = bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace(_MARK, " ").encode()
            self.second_bytes.append(told)
        self.sizes = [np.array([len(b) for b in x], np.int64) for x in (self.first_bytes, self.second_bytes)]
        joins = any(re.search(rf"[^{_MARK}]{_MARK}|\n", p) for p in pieces)
        self.cuts = not joins and self.first["spaced"]
        #: Characters that a piece of the second tokenizer joins with a stop behind them.
        self.stops = {stop: {p[i - 1] for p in pieces for i in range(1, len(p)) if p[i] == stop} for stop in ".,"}
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.letters = 0
        self.used = np.zeros(1 << 12, np.int64)
        self.fine = np.zeros(1 << 12, bool)
        #: Units with a link that has no count: they stand only in texts without tokens.
        self.uncounted = np.zeros(1 << 12, bool)
        #: Of each unit: tokens of both, groups, links of the highest count, sum of counts.
        self.told = np.zeros((1 << 12, 5), np.int64)
        self.groups: list[str] = []
        self.bounds = np.zeros(1 << 12, np.int64)
        self.links = np.zeros(1 << 14, np.int64)

    def forget(self) -> None:
        """Drop the units that were met once, and of too many others the rarer ones."""
        n = len(self.index)
        used = self.used[:n]
        least = 2
        if np.count_nonzero(used >= least) > KEPT // 2:
            least = max(2, int(np.partition(used, n - KEPT // 2)[n - KEPT // 2]) + 1)
        kept = np.flatnonzero(used >= least)
        names = list(self.index)
        old = self.__dict__.copy()
        self.clear()
        for i in kept.tolist():
            self.index[names[i]] = len(self.index)
            self.letters += len(names[i])
        k = len(kept)
        for name in ("fine", "uncounted", "used", "told"):
            setattr(self, name, old[name][:n][kept].copy())
        self.used[:] = 0
        if self.counts is None:
            at = _spans(old["bounds"][kept], old["told"][kept, 2])
            self.links = old["links"][at]
            self.bounds = np.concatenate([[0], np.cumsum(self.told[:k, 2])])
        else:
            self.groups = [old["groups"][i] for i in kept.tolist()]

    def units(self, text: str) -> list[str]:
        """The text behind a space, cut; the units joined are that text."""
        # The cheap look lets no text with other white space pass, and sends a few more to the search.
        doubtful = not text.replace("\n", "").isprintable() or text[-1] == " " or text[0].isspace()
        doubtful = doubtful or any(pair in text for pair in _DOUBTFUL)
        text = " " + text
        if not self.cuts:
            return [text]
        if doubtful and _UNCLEAR.search(text):
            return _CUT.split(text)
        return [u for u in text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if u]

    def _encode_first(self, units: list[str]) -> list[list[int]]:
        """Ids of units: one piece of letters goes to the merges alone, others are encoded whole."""
        merge, letters = self.first["tokenizer"].model.tokenize, self.first["letters"]
        out: list = [None] * len(units)
        rest = []
        for i, u in enumerate(units):
            spaced = u[0] == " "
            body = u[1:] if spaced else u
            if not body.isalpha() or not self.cuts:
                rest.append(i)
                continue
            if not body.isascii():
                if max(body) >= "ɐ":
                    rest.append(i)
                    continue
                body = body.encode().decode("latin-1").translate(letters)
            out[i] = [t.id for t in merge(letters[32] + body if spaced else body)]
        coded = self.first["tokenizer"].encode_batch_fast([units[i] for i in rest], add_special_tokens=False)
        for i, c in zip(rest, coded):
            out[i] = c.ids
        return out

    def _encode_second(self, units: list[str]) -> list[list[int]]:
        """The tokenizer puts a mark before a text: instead of the unit's own space, or cut off."""
        spaced = [u[1:] if u[:1] == " " and len(u) > 1 else "\n" + u for u in units]
        coded = self.second.encode(spaced, num_threads=1)
        # A single space is the mark itself; after a line end two ids stand before the unit's own.
        return [
            ids if u[:1] == " " and len(u) > 1 else ids[:1] if u == " " else ids[2:]
            for u, ids in zip(units, coded)
        ]

    def learn(self, units: list[str]) -> None:
        """Encode and align units that are not known yet.

        A unit with a stop behind a letter or digit is put together from both.
        """
        ended = [u for u in units if u[-1] in self.stops and u[-2:-1].isalnum() and u[-2] not in self.stops[u[-1]]]
        if not ended or not self.cuts:
            self._learn_whole(units)
            return
        parts = {u[:-1] for u in ended} | {u[-1] for u in ended}
        self._learn_whole([u for u in parts.union(units).difference(ended) if u not in self.index])
        at, n = len(self.index), len(ended)
        stems = np.fromiter((self.index[u[:-1]] for u in ended), np.int64, n)
        stops = np.fromiter((self.index[u[-1]] for u in ended), np.int64, n)
        self._room(n)
        for held in (self.fine, self.uncounted, self.told):
            join = np.add if held is self.told else np.logical_and if held is self.fine else np.logical_or
            held[at : at + n] = join(held[stems], held[stops])
        self.told[at : at + n] *= self.fine[at : at + n, None]
        if self.counts is None:
            both = np.stack([stems, stops], axis=1)
            sizes = self.told[both, 2] * self.fine[at : at + n, None]
            links = self.links[_spans(self.bounds[both].ravel(), sizes.ravel())]
            self._keep_links(at, links, np.cumsum(sizes.sum(axis=1)))
        else:
            self.groups += [
                f"{self.groups[a]};{self.groups[b]}" for a, b in zip(stems.tolist(), stops.tolist())
            ]
        for u in ended:
            self.index[u] = len(self.index)
            self.letters += len(u)

    def _room(self, n: int) -> None:
        """Arrays hold ``n`` units more."""
        size = len(self.index) + n + 1
        for name in ("fine", "uncounted", "used", "bounds"):
            setattr(self, name, _grown(getattr(self, name), size))
        if size > len(self.told):
            self.told = np.concatenate([self.told, np.zeros((max(n + 1, len(self.told)), 5), np.int64)])

    def _keep_links(self, at: int, links: np.ndarray, upto: np.ndarray) -> None:
        base = int(self.bounds[at])
        self.bounds[at + 1 : at + len(upto) + 1] = base + upto
        self.links = _grown(self.links, base + len(links))
        self.links[base : base + len(links)] = links

    def _learn_whole(self, units: list[str]) -> None:
        if not units:
            return
        sides: list[list] = [[], []]
        if self.cuts:  # a space and ASCII letters: the most usual kind, taken without questions
            plain = [u for u in units if u[0] == " " and u.isascii() and u[1:].isalpha()]
            if plain:
                merge, mark = self.first["tokenizer"].model.tokenize, self.first["letters"][32]
                marked = "\n".join(plain).replace(" ", mark).split("\n")
                sides[0] = [[t.id for t in merge(u)] for u in marked]
                sides[1] = self.second.encode([u[1:] for u in plain], num_threads=1)
                units = plain + list(set(units).difference(plain))
        others = units[len(sides[0]) :]
        sides[0] += self._encode_first(others)
        sides[1] += self._encode_second(others)
        raw, n = [u.encode() for u in units], len(units)
        lengths = [np.fromiter(map(len, side), np.int64, len(side)) for side in sides]
        flat = [np.fromiter(chain.from_iterable(side), np.int64) for side in sides]
        whole = b"".join(raw)
        fine = np.ones(n, bool)
        for ids, side, table in zip(flat, sides, (self.first_bytes, self.second_bytes)):
            if b"".join(map(table.__getitem__, ids.tolist())) != whole:
                fine &= [b"".join(table[i] for i in x) == r for x, r in zip(side, raw)]
        if not fine.all():  # units that differ from their tokens are known, but have none
            flat = [ids[np.repeat(fine, n)] for ids, n in zip(flat, lengths)]
            lengths = [n * fine for n in lengths]
        size = np.fromiter(map(len, raw), np.int64, n) * fine
        ends = [np.cumsum(table[ids]) for table, ids in zip(self.sizes, flat)]
        both = np.intersect1d(*ends, assume_unique=True)
        last = [np.searchsorted(e, both) for e in ends]
        links = flat[0][last[0]] * PAIR + flat[1][last[1]]
        upto = np.searchsorted(both, np.cumsum(size), "right")
        before = np.concatenate([[0], upto[:-1]])
        at = len(self.index)
        self._room(n)
        self.fine[at : at + n] = fine
        told = self.told[at : at + n]
        told[:, 0], told[:, 1], told[:, 2] = *lengths, upto - before
        if self.counts is None:
            self._keep_links(at, links, upto)
        else:
            parts = (links % PAIR) % PARTS
            sums, best = self.counts.look_up(parts, links, ["sums", "best"])
            absent = np.concatenate([[0], np.cumsum(sums == 0)])
            self.uncounted[at : at + n] = absent[upto] > absent[before]
            for column, values in ((3, best), (4, sums)):
                upon = np.concatenate([[0], np.cumsum(values)])
                told[:, column] = upon[upto] - upon[before]
            self.groups += self._group_texts(flat, last, lengths)
        self.index.update(zip(units, range(at, at + n)))
        self.letters += len(whole)

    @staticmethod
    def _group_texts(flat: list[np.ndarray], last: list[np.ndarray], lengths: list[np.ndarray]) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each unit."""
        closes, places, units = [], [], []
        for side in (0, 1):
            close = np.zeros(len(flat[side]), bool)
            close[last[side]] = True
            closes.append(close)
            places.append(2 * (np.cumsum(close) - close) + side)
            units.append(np.repeat(np.arange(len(lengths[side])), lengths[side]))
        order = np.argsort(np.concatenate(places), kind="stable")
        signs = np.concatenate([np.where(closes[0], "|", ","), np.where(closes[1], ";", ",")])[order]
        ids = np.concatenate(flat)[order]
        unit = np.concatenate(units)[order]
        parts = [f"{i}{s}" for i, s in zip(ids.tolist(), signs.tolist())]
        ends = np.searchsorted(unit, np.arange(len(lengths[0])), "right").tolist()
        return ["".join(parts[lo:hi])[:-1] for lo, hi in zip([0, *ends[:-1]], ends)]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit numbers of all texts, the bounds of the texts in them, and which texts have tokens."""
        if len(self.index) > KEPT or self.letters > KEPT_LETTERS:
            self.forget()
        cut = [self.units(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        sizes = [len(units) for units in cut]
        new = list(set(flat).difference(self.index))
        if new:
            collecting = gc.isenabled()
            gc.disable()  # many small lists, none of them in a cycle
            self.learn(new)
            if collecting:
                gc.enable()
        del cut
        numbers = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        self.used[: len(self.index)] += np.bincount(numbers, minlength=len(self.index))
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        wrong = np.concatenate([[0], np.cumsum(~self.fine[numbers])])
        fine = (wrong[bounds[1:]] == wrong[bounds[:-1]]) & (bounds[1:] > bounds[:-1])
        return numbers, bounds, fine


def _open(first: str, second: str, counts: str | None) -> Aligner:
    """The worker's aligner for these files; another one goes."""
    state = worker_state("aligner", large=True)
    key = (first, second, counts)
    if key not in state:
        state.clear()
        made = Aligner(first, second, PartFiles(counts) if counts else None)
        state = worker_state("aligner", large=True)  # the tokenizer's own store is not needed beside it
        state[key] = made
    return state[key]


def tally_links(docs: DataFrame, text: str, first: str, second: str) -> DataFrame:
    """``task, part, keys, counts``: how often each task's texts link a pair of ids.

    A key is ``a * 2**32 + b``; ``part`` depends on ``b`` alone, so all pairs of one ``b`` share it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _open(first, second, None)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            every, weight = np.concatenate([held[0], *keys]), np.concatenate([held[1], *counts])
            order = np.argsort(every)
            told, first = np.unique(every[order], return_index=True)
            keys.clear()
            counts.clear()
            return told, np.add.reduceat(weight[order], first) if len(told) else weight

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy()
            for lo, hi in row_ranges(sizes, _TEXT):
                numbers, bounds, fine = aligner.read(batch.column("_text").slice(lo, hi - lo).to_pylist())
                numbers = numbers[np.repeat(fine, np.diff(bounds))]
                told, times = np.unique(numbers, return_counts=True)
                n = aligner.told[told, 2]
                keys.append(aligner.links[_spans(aligner.bounds[told], n)])
                counts.append(np.repeat(times, n))
                if sum(map(len, keys)) > _PAIRS:
                    held = added()
        held = added()
        part = (held[0] % PAIR) % PARTS
        for p in np.unique(part).tolist():
            some = part == p
            columns = [
                pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([p], pa.int32()),
                pa.array([held[0][some].tobytes()], pa.binary()),
                pa.array([held[1][some].tobytes()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["task", "part", "keys", "counts"])

    given = docs.select(F.col(text).alias("_text"))
    return given.mapInArrow(run, "task long, part int, keys binary, counts binary")


def count_links(docs: DataFrame, text: str, first: str, second: str) -> tuple[DataFrame, str]:
    """The table of linked pairs by part, with their counts, and its address.

    Columns by place in the part's hash: ``keys`` (``a * 2**32 + b``), ``sums``, and ``best``: 1 if no
    pair of the same ``b`` has a higher count.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for keys, sums in zip(batch.column("keys").to_pylist(), batch.column("sums").to_pylist()):
                b, n = np.frombuffer(keys, "<i8") % PAIR, np.frombuffer(sums, "<i8")
                highest = np.zeros(int(b.max()) + 1, np.int64)
                np.maximum.at(highest, b, n)
                flags.append((n == highest[b]).astype(np.int64).tobytes())
            yield batch.append_column("best", pa.array(flags, pa.binary()))

    tallies = freeze(tally_links(docs, text, first, second), "pair-tallies")
    hashes, uri = write_hashes(tallies, "pair-hashes")
    counted = with_sums(tallies, hashes, uri, "pair-sums")
    counted = counted.select("part", "levels", "sizes", "keys", "sums")
    schema = StructType([*counted.schema]).add("best", "binary")
    return write_parts(counted.mapInArrow(best, schema), "pair-table")


def linked_pairs(table: DataFrame) -> DataFrame:
    """``a, b, count, best`` of each linked pair, from the table of ``count_links``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, sums, best = (np.frombuffer(row[c], "<i8") for c in ("keys", "sums", "best"))
                columns = [pa.array(x) for x in (keys // PAIR, keys % PAIR, sums, best == 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "count", "best"])

    given = table.select("keys", "sums", "best")
    return given.mapInArrow(run, "a long, b long, count long, best boolean")


def align(
    docs: DataFrame, text: str, carried: list[str], first: str, second: str, counts: str,
    digest: bool = False,
) -> DataFrame:
    """``carried`` columns of each row with the figures of its alignment.

    ``first`` is a byte-level tokenizers file, ``second`` a sentencepiece file with byte fallback;
    both encode the text behind one space, and strings of special tokens are ordinary text.  Tokens
    are cut into ``groups`` where both end at one byte; the tokens that end there are linked.
    ``n_a, n_b, n_groups, n_links`` count tokens, groups and links, ``n_best`` the links whose pair is
    the most frequent of its second id by the table at ``counts``, and ``count_sum`` adds the counts
    of all links.  ``groups`` is ``a1,a2|b1;a3|b2,b3``, with ``digest`` its sha256 as
    ``groups_sha256``.  A null or empty text, and one whose tokens do not join to its bytes, has no
    tokens: zeros and an empty text.  Repeated rows count once each; an empty table gives an empty
    result.  No row moves; memory is bounded by a batch, the longest text, and the parts in use.
    """
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    last = "groups_sha256" if digest else "groups"
    inner = [f"_{i}" for i in range(len(carried))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _open(first, second, counts)
        for batch in batches:
            give_back()
            sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy()
            for lo, hi in row_ranges(sizes, _TEXT):
                part = batch.slice(lo, hi - lo)
                numbers, bounds, fine = aligner.read(part.column("_text").to_pylist())
                if aligner.uncounted[numbers[np.repeat(fine, np.diff(bounds))]].any():
                    raise KeyError("a link without a count: the table was made from other texts")
                upon = np.zeros((len(numbers) + 1, 5), np.int64)
                np.cumsum(aligner.told[numbers], axis=0, out=upon[1:])
                told = (upon[bounds[1:]] - upon[bounds[:-1]]) * fine[:, None]
                texts = []
                listed = numbers.tolist()
                for good, a, b in zip(fine.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    whole = ";".join([aligner.groups[i] for i in listed[a:b]]) if good else ""
                    texts.append(hashlib.sha256(whole.encode()).hexdigest() if digest and good else whole)
                figures = [told[:, i] for i in (0, 1, 2, 2, 3, 4)]
                columns = [part.column(n) for n in inner] + [pa.array(f) for f in figures]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.string())], [*carried, *names, last]
                )

    given = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, inner)], F.col(text).alias("_text"))
    schema = StructType([docs.schema[c] for c in carried])
    for name in names:
        schema = schema.add(name, "long")
    return given.mapInArrow(run, schema.add(last, "string"))
