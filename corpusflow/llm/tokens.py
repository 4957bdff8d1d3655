"""Byte-level BPE ids of whole texts, by ``tokenizers``, with a word cache.

Pre-tokens of this vocabulary never reach across a single space before a word,
so a text is cut there and each piece is looked up; unseen pieces are cut by the
published pre-token pattern and only unseen pre-tokens are merged. Ids equal
those of encoding the text as a whole (tests/llm checks this). ``with_added``
first cuts a text at the tokenizer's added tokens, as the library does by default;
``ids`` takes their strings for ordinary text. ``many`` is ``with_added`` of a
column: a few megabytes of texts are cut at a time, at spaces and wherever two bytes
show that a pre-token ends, only their distinct pieces are looked up, unseen
pre-tokens go to the library a thousand a call, and the ids are laid out by the
pieces' numbers. Arrow's unused memory is given back after each of these blocks: a
worker that is kept for other work holds little besides the cache.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusflow.llm.texthash import text_buffer

BYTES_PER_ID = 4
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: white space on both sides of a space: such a text is cut by the pattern as a whole
_HARD = re.compile(f"[{_WS}] (?=[{_WS}])|^ (?=[{_WS}])")
#: the same for Arrow, and NUL, which parts pre-tokens in a row
_ODD = rf"(?:\A|[{_WS}]) [{_WS}]|\x00"

# kinds of bytes for ``_piece_starts``; of other bytes nothing is known
_OTHER, _LETTER, _DIGIT, _MARK, _QUOTE, _LINE, _SPACE = range(7)
_KIND = np.zeros(256, np.uint8)
for _c in range(33, 127):
    _KIND[_c] = _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit() else _QUOTE if _c == 39 else _MARK
_KIND[9:14], _KIND[32] = _LINE, _SPACE
_LATIN = np.zeros(256, bool)  # second bytes of U+00C0 to U+00FF that are letters
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: _ENDS[8 * a + b]: a pre-token ends between bytes of the kinds a and b, whatever else is in the text
_ENDS = np.zeros(64, bool)
for _a, _after in ((_LETTER, (_DIGIT, _MARK, _QUOTE, _LINE)), (_DIGIT, (_LETTER, _MARK, _QUOTE, _LINE)), (_MARK, (_LETTER, _DIGIT, _LINE))):
    _ENDS[[8 * _a + _b for _b in _after]] = True
_SOLID = np.isin(np.arange(7), (_LETTER, _DIGIT, _MARK, _QUOTE))


def _piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of texts that lie end to end (UTF-8, ``offsets`` their bounds).

    A cut between two pre-tokens leaves both sides' pre-tokens as they are. Before a
    space that holds but for the texts of ``_HARD``. Letters, digits and marks end where
    another of these or a line break follows, but an apostrophe may be of a contraction.
    A single line break between two of them is a pre-token.
    """
    kind = _KIND[raw]
    latin = np.flatnonzero(raw[:-1] == 0xC3) + 1
    kind[latin[_LATIN[raw[latin]]]] = _LETTER
    first = np.zeros(len(raw) + 1, bool)
    first[1:-1] = _ENDS[8 * kind[:-1] + kind[1:]]
    first[:-1] |= kind == _SPACE
    line = np.flatnonzero(kind[1:-1] == _LINE) + 1
    first[line[_SOLID[kind[line - 1]] & _SOLID[kind[line + 1]]] + 1] = True
    first[offsets] = True
    return np.flatnonzero(first[:-1])


class _Pieces(dict):
    """Ids of pieces by piece, made by ``make`` when first asked for; a full cache is emptied."""

    def __init__(self, make, size: int) -> None:
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, piece: str) -> bytes:
        found = self.make(piece)
        if len(piece) <= 64:
            if len(self) >= self.size:
                self.clear()
            self[piece] = found
        return found

    def add(self, found: dict[str, bytes], used: Iterable[tuple[str, bytes]]) -> None:
        """Keep what was made elsewhere, under the same bounds; of a full cache the pieces ``used`` just now stay, if there is room."""
        if max(map(len, found), default=0) > 64 or len(found) > self.size:
            found = dict(islice(((p, x) for p, x in found.items() if len(p) <= 64), self.size))
        if len(self) + len(found) > self.size:
            kept = dict(islice(used, self.size - len(found)))
            self.clear()
            self.update(kept)
        self.update(found)


class Encoder:
    """``ids(text)`` and ``with_added(text)``: little-endian unsigned 32-bit ids of a text, as bytes."""

    CACHE = 300_000  # pieces and pre-tokens; a full cache is emptied, so a worker's memory stays bounded
    ROW = 1000  # unseen pre-tokens of a call of the library
    BLOCK = 8 << 20  # bytes of texts that ``many`` cuts at a time; a longer text is a block of its own

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its core, not all of them
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        whole = Tokenizer.from_file(path)
        self.model = whole.model
        added = whole.get_added_tokens_decoder()
        for t in added.values():
            if t.single_word or t.lstrip or t.rstrip or (t.normalized and whole.normalizer):
                raise ValueError(f"added token with rules of its own: {t.content!r}")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        # as in the library, the leftmost match counts and of those the longest
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.odd = "|".join([_ODD, *map(re.escape, longest)])
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # the vocabulary's printable stand-ins for bytes, by its published rule
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        shown |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)}
        self.shown = {b: shown[b] for b in range(256)}
        # pre-tokens in a row are cut at the stand-in of NUL, whose own id then parts their ids
        self.points = np.array([ord(shown[b]) for b in range(256)], "<u4")
        self.nul = self.model.token_to_id(shown[0])
        self.row = Tokenizer(self.model)
        self.row.pre_tokenizer = pre_tokenizers.Split(shown[0], "isolated")
        # cut alone, a pre-token stays whole, so one cache holds both
        self.pieces = self.tokens = _Pieces(self._piece, self.CACHE)

    def _merged(self, token: str) -> bytes:
        # of the printable ASCII characters only the space has a stand-in
        text = (token.replace(" ", self.shown[32]) if token.isascii() and token.isprintable()
                else token.encode().decode("latin-1").translate(self.shown))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _cut(self, piece: str) -> tuple[str, ...] | list[str]:
        """Pre-tokens of a piece."""
        if not piece:
            return ()
        # the pattern's commonest cases: letters alone, or letters and one mark
        body, mark = (piece, "") if piece[-1] not in ",.!?;:" else (piece[:-1], piece[-1])
        if body[1:].isalpha() and (body[0] == " " or body[0].isalpha()):
            return (body, mark) if mark else (body,)
        return self.pattern.findall(piece)

    def _piece(self, piece: str) -> bytes:
        cut = self._cut(piece)
        return self._merged(piece) if len(cut) == 1 else b"".join(map(self.pieces.__getitem__, cut))

    def _merged_row(self, tokens: list[str]) -> Iterator[bytes]:
        """``_merged`` of each; no token has a NUL."""
        if self.nul is None:
            yield from map(self._merged, tokens)
            return
        for k in range(0, len(tokens), self.ROW):
            row = np.frombuffer(("\0".join(tokens[k:k + self.ROW]) + "\0").encode(), np.uint8)
            shown = self.points[row].tobytes().decode("utf-32-le")
            ids = np.array(self.row.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            values = ids.tobytes()
            ends = (BYTES_PER_ID * np.flatnonzero(ids == self.nul)).tolist()
            yield from (values[a + BYTES_PER_ID:b] for a, b in pairwise([-BYTES_PER_ID, *ends]))

    def _pieces_row(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, none of which has a NUL."""
        found = list(map(self.pieces.get, pieces))
        new = [p for p, x in zip(pieces, found) if x is None]
        whole = [p for p in new if p[1:].isalpha() and (p[0] == " " or p[0].isalpha())]
        cuts = {p: self._cut(p) for p in set(new).difference(whole)} if len(whole) < len(new) else {}
        parts = (t for t in chain.from_iterable(cuts.values()) if t not in self.pieces)
        unseen = list(dict.fromkeys(chain(whole, parts)))
        made = dict(zip(unseen, self._merged_row(unseen)))
        made |= {p: b"".join([made[t] if t in made else self.pieces[t] for t in cut]) for p, cut in cuts.items()}
        self.pieces.add(made, (h for h in zip(pieces, found) if h[1] is not None))
        return [made[p] if x is None else x for p, x in zip(pieces, found)]

    def with_added(self, text: str) -> bytes:
        """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""
        if self.cuts is None or not self.cuts.search(text):
            return self.ids(text)
        return b"".join(self.added[p] if k % 2 else self.ids(p) for k, p in enumerate(self.cuts.split(text)))

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _HARD.search(text):
            return b"".join(map(self.tokens.__getitem__, self.pattern.findall(text)))
        # each piece but the first keeps the space before it
        if "\0" in text:
            first, *rest = text.split(" ")
            parts = [first, *(" " + p for p in rest)]
        else:
            parts = text.replace(" ", "\0 ").split("\0")
        return b"".join(map(self.pieces.__getitem__, parts))

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """``with_added`` of each text; a null is an empty text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        block = (np.cumsum(size) - size) // self.BLOCK
        for a, b in pairwise([0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]):
            yield from self._block(texts.slice(a, b - a))
            pa.default_memory_pool().release_unused()

    def _block(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, self.odd)
        raw, offsets = text_buffer(texts.filter(pc.invert(odd)))
        starts = _piece_starts(raw, offsets)
        bounds = pa.py_buffer(np.append(starts, len(raw)))
        found = pa.LargeStringArray.from_buffers(len(starts), bounds, pa.py_buffer(raw)).dictionary_encode()
        made = pa.array(self._pieces_row(found.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        ids = made.take(found.indices)
        # the ids of a text lie end to end in the pieces' values
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(starts, offsets)].tolist()
        values, spans = memoryview(ids.buffers()[2] or b""), pairwise(ends)
        for text, is_odd in zip(texts, odd.to_pylist()):
            if is_odd:
                yield self.with_added(text.as_py())
            else:
                a, b = next(spans)
                yield bytes(values[a:b])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, and so one cache, per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
