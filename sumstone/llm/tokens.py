"""Token ids of whole texts, by the tokenizers library, with known words kept by the worker.

A byte-pair encoder cuts a text into pieces before it merges anything, and no piece spans the
border between a word and the space before it.  So a text's ids are those of its words, one after
another; words repeat, and their ids are kept while the Python worker lives.  Texts in which white
space meets white space are encoded whole.

Where the encoder drops white space, texts are cut with array operations, also between a letter and
the mark that follows it; only words that differ are looked up, once a call.
"""

from __future__ import annotations

import unicodedata
from array import array

import numpy as np
import pyarrow as pa

from sumstone.llm.common import SPACES, lower_ascii, text_bytes, worker_state

#: Words kept; those that do not come up again are dropped by halves.
KEPT = 600_000

_END = 0xFFFFFFFF
_MARKS = ("\0", "\1", "\2")
_STOPS = (".", ",")
_BORDER = "ɐ"


def _byte_letters() -> dict[int, str]:
    """Latin-1 code -> the letter that stands for this byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(256 + i) for i, b in enumerate(others)}


def _byte_kinds(tokenizer) -> np.ndarray:
    """Kind of each byte: 0 white space, 1 ASCII letter, 2 starts a piece after a letter, 3 other."""
    kinds = np.full(256, 3, np.uint8)
    kinds[list(SPACES)] = 0
    split = tokenizer.pre_tokenizer
    for b in range(33, 127):
        if chr(b).isalpha():
            kinds[b] = 1
        elif b != ord("'") and split and len(split.pre_tokenize_str("q" + chr(b))) == 2:
            kinds[b] = 2  # an apostrophe may belong to letters on both of its sides
    return kinds


def open_tokenizer(path: str) -> dict:
    """The tokenizer at ``path`` with its word store, opened once a worker."""
    state = worker_state("tokens", large=True)
    if path not in state:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        state[path] = {
            "tokenizer": tokenizer,
            "spaced": ids("a b") != ids("a") + ids("b"),
            "lower": ids("Q") == ids("q"),
            "letters": _byte_letters(),
            "kinds": _byte_kinds(tokenizer),
            "words": {},  # met in the present half of the store
            "old": {},  # met in the half before
            "odd": set(),  # words that cannot stand alone
        }
    return state[path]


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _stays_letter(c: str) -> bool:
    """False for a letter that normalizing or lowering ends with a mark, which a stop would join."""
    return c.isascii() or unicodedata.normalize("NFC", c).lower()[-1].isalpha()


def _learn(state: dict, unknown: list[str]) -> None:
    """Add the ids of ``unknown`` words; None for one that cannot stand alone."""
    words, old, tokenizer, spaced = state["words"], state["old"], state["tokenizer"], state["spaced"]
    letters, lower, merge = state["letters"], state["lower"], tokenizer.model.tokenize
    bare = [w for w in unknown if w.lstrip(" ").isalpha()]  # letters only, with a space before at most
    whole: list[str] = [w for w in _STOPS if w not in words]
    ended: list[str] = []  # letters and one full stop or comma
    for word in set(unknown).difference(bare):
        body = word[1:] if spaced and word[:1] == " " else word
        if body[-1:] in _STOPS and body[:-1].isalpha() and _stays_letter(body[-2]):
            ended.append(word)
        elif not spaced or word == "\n" or body.split() == [body]:
            whole.append(word)
        else:
            words[word] = None
            state["odd"].add(word)
    for stem in {w[:-1] for w in ended}.difference(words, bare):
        if stem in old:
            words[stem] = old[stem]
        else:
            bare.append(stem)
    # Letters below the border have one form and keep it: nothing but the merges is left to do.
    plain = [w for w in bare if w.isascii()]
    joined = "\n".join(plain).replace(" ", letters[32])
    others = []
    for w in bare:
        if not w.isascii():
            (others if max(w.lower() if lower else w) < _BORDER else whole).append(w)
    rest = "\n".join(others)
    rest = (rest.lower() if lower else rest).encode().decode("latin-1").translate(letters)
    pieces = (joined.lower() if lower else joined).split("\n") + rest.split(letters[10])
    coded = [array("I", [t.id for t in merge(p)]).tobytes() for p in (pieces if plain else pieces[1:])]
    words.update(zip([*plain, *others], coded))
    for word, coded in zip(whole, tokenizer.encode_batch(whole, add_special_tokens=False)):
        words[word] = _packed(coded.ids)
    for word in ended:
        words[word] = words[word[:-1]] + words[word[-1]]


def _encode_spaced(state: dict, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
    """``encode`` where a space belongs to the word behind it."""
    tokenizer = state["tokenizer"]
    words, old, odd_words = state["words"], state["old"], state["odd"]
    words["\1"] = _packed([_END])

    def chunks(text: str) -> list[str]:
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    alone: dict[int, str] = {}
    plain: list[str] = []
    for i, text in enumerate(texts):
        text = text or ""
        # A control sign makes a text unprintable, as line ends do: most need no closer look.
        control = not text.replace("\n", "").isprintable()
        if not text or control and any(c in text for c in _MARKS):
            alone[i], text = text, f"\2{i}"
        plain.append(text)
    gap = "\0\1\0"
    found = chunks(gap.join([*plain, ""])[:-1])
    known = set(found)
    unknown = []
    for w in known.difference(words):
        if w in old:
            words[w] = old[w]
        elif w[:1] != "\2":
            unknown.append(w)
    _learn(state, unknown)
    if not known.isdisjoint(odd_words):
        for i, text in enumerate(plain):
            if i not in alone and any(words[w] is None for w in chunks(text)):
                alone[i], plain[i] = text, f"\2{i}"
        found = chunks(gap.join([*plain, ""])[:-1])
    if alone:
        coded = tokenizer.encode_batch(list(alone.values()), add_special_tokens=False)
        own = {f"\2{i}": _packed(c.ids) for i, c in zip(alone, coded)}
        packed = b"".join([own[w] if w[:1] == "\2" else words[w] for w in found])
    else:
        packed = b"".join(map(words.__getitem__, found))
    ids = np.frombuffer(packed, "<u4").copy()
    ends = np.flatnonzero(ids == _END)
    ids[ends] = end
    return ids, np.concatenate([[0], ends + 1])


def _cut(state: dict, texts: list[str | None] | pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts without white space, and how many stand before each text.

    A word ends at white space, and where a mark follows a letter.  A-Z are lowered if the encoder
    does so, but not in texts with code points above U+00FF: it composes letters first.
    """
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.large_string())
    data, offs = text_bytes(texts)
    data, offs = data[offs[0] : offs[-1]], offs - offs[0]
    kinds = state["kinds"][data]
    inside, letter = kinds != 0, kinds == 1
    if len(data) and data.max() >= 0x80:  # U+00C0 to U+00FF are letters but for two signs
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (letter[:-1] & (kinds[1:] == 2))
    first = offs[:-1][offs[1:] > offs[:-1]]
    begins[first] = inside[first]
    if state["lower"]:
        lowered = lower_ascii(data)
        for row in np.unique(np.searchsorted(offs, np.flatnonzero(data >= 0xC4), "right") - 1):
            lowered[offs[row] : offs[row + 1]] = data[offs[row] : offs[row + 1]]
        data = lowered
    before = np.searchsorted(np.flatnonzero(begins), offs)
    bounds = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside))
    buffers = [pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[inside])]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, *buffers), before


def _encode_cut(
    state: dict, texts: list[str | None] | pa.Array, end: int
) -> tuple[np.ndarray, np.ndarray]:
    """``encode`` where white space has no ids."""
    words, old = state["words"], state["old"]
    cut, before = _cut(state, texts)
    coded = cut.dictionary_encode()
    found = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    unknown = []
    for w in found:
        if w not in words:
            if w in old:
                words[w] = old[w]
            else:
                unknown.append(w)
    _learn(state, unknown)
    own = [*map(words.__getitem__, found), _packed([end])]
    pool = np.frombuffer(b"".join(own), "<u4")
    sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
    places = np.insert(coded.indices.to_numpy(), before[1:], len(found))  # ends after the words
    lengths = sizes[places]
    starts, ends = (np.cumsum(sizes) - sizes)[places], np.cumsum(lengths)
    ids = pool[np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())]
    return ids, np.append(0, ends[before[1:] + np.arange(len(before) - 1)])


def encode(
    path: str, texts: list[str | None] | pa.Array, end: int, kept: int = KEPT
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end``, and the bounds of the texts in them."""
    state = open_tokenizer(path)
    if 2 * len(state["words"]) > kept:  # words that come up again move to the new half
        state["old"], state["words"] = state["words"], {}
        state["odd"] = {w for w in state["odd"] if w in state["old"]}
    if not state["spaced"]:
        return _encode_cut(state, texts, end)
    return _encode_spaced(state, texts.to_pylist() if isinstance(texts, pa.Array) else texts, end)
