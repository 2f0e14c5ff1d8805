"""Token ids by the `tokenizers` library, with a memo of pieces of text.

Byte-level BPE splits a text into pre-tokens and never merges across them. A space between a visible
character and another visible character always begins a pre-token, and so does the character after a
lone line break between visible characters, so the ids of a text are the ids of the pieces between
such places, one after the other. Pieces repeat far more than texts do; each distinct piece is
encoded once by the library and remembered (up to MEMO_PIECES per worker), and whole blocks of texts
are put together from remembered pieces by array operations.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

from heliograph.llm import textvec

MEMO_PIECES = 800_000
_BREAK = "\u010a"  # how byte-level pre-tokenizers show a line break
_ODD = re.compile(r"\s")
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_ASCII_SPACES = [c for c in _SPACES if c.isascii()]
_SPACED = np.uint64(0x5BD1E9955BD1E995)
YOUNG_PIECES = 1 << 16
STEMS = 50_000
#: How byte-level pre-tokenizers show bytes: printable Latin-1 as itself, the rest from 256 upwards in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_encoders: dict[str, Encoder] = {}


class Encoder:
    """ids(text): the library's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")
        self.memo: dict[str, bytes] = {}
        self.table = Table(array("I", self.library.encode("\n", add_special_tokens=False).ids).tobytes())

    def _encode(self, pieces: list[str]) -> None:
        """Adds pieces to the memo; a closing full stop or comma after a letter is a pre-token of its own."""
        memo, stops = self.memo, []
        merge, plain, needed = self.library.model.tokenize, [], set()
        for p in pieces:
            if p and p[-1] in ".," and p[-2:-1].isalpha() and p[-2:-1].isascii():
                stops.append(p)
                needed.add(p[:-1])
                needed.add(p[-1])
            elif p:
                needed.add(p)
        for x in needed:
            if x in memo:
                continue
            if x.isalpha() or x[0] == " " and x[1:].isalpha():  # one pre-token
                shown = "\u0120" + x[1:] if x[0] == " " else x  # how byte-level pre-tokenizers show a space
                if not x.isascii():
                    shown = x.encode().decode("latin-1").translate(_SHOWN)
                memo[x] = array("I", [t.id for t in merge(shown)]).tobytes()
            elif _ODD.search(x, 1) or x == " " or (x[0] != " " and x[0].isspace()) or self.special.search(x):
                memo[x] = array("I", self.library.encode(x, add_special_tokens=False).ids).tobytes()
            else:
                plain.append(x)
        for at in range(0, len(plain), 4096):
            self._encode_plain(plain[at : at + 4096])
        for p in stops:
            memo[p] = memo[p[:-1]] + memo[p[-1]]

    def _encode_plain(self, pieces: list[str]) -> None:
        """Pieces without inner white space: the library splits them in one go, line breaks between them, and merges each pre-token."""
        known, held, at = {}, [], 0
        for token, _ in self.library.pre_tokenizer.pre_tokenize_str("\n".join(pieces)):
            if token == _BREAK:
                self.memo[pieces[at]] = b"".join(held)
                held, at = [], at + 1
            else:
                ids = known.get(token)
                if ids is None:
                    ids = known[token] = array("I", [t.id for t in self.library.model.tokenize(token)]).tobytes()
                held.append(ids)
        self.memo[pieces[at]] = b"".join(held)

    def ids(self, text: str) -> bytes:
        """One text's ids, piece by piece."""
        pieces, memo = split(text), self.memo
        missing = {p for p in pieces if p not in memo}
        if len(memo) + len(missing) > MEMO_PIECES:
            memo.clear()
            missing = set(pieces)
        self._encode(list(missing))
        return b"".join([memo[p] for p in pieces])

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Texts with plain spacing go in blocks, their pieces looked up by hash."""
        out: list[bytes | None] = [None] * len(texts)
        plain = [i for i, x in enumerate(texts) if x and _is_plain(x)]
        self.table.trim()
        for first, end, data, starts in textvec.blocks([texts[i].encode() for i in plain]):
            for i, ids in zip(plain[first:end], self._block(data, starts)):
                out[i] = ids
        return [self.ids(x) if ids is None else ids for x, ids in zip(texts, out)]

    def _block(self, data: np.ndarray, starts: np.ndarray) -> list[bytes]:
        begin, end = textvec.word_spans(data)
        before = np.where(begin > 0, data[begin - 1], 0)
        before[np.searchsorted(begin, starts)] = 0  # what stands before a text isn't part of it
        spaced = before == 0x20
        keys = textvec.span_hashes(data, begin, end) ^ np.where(spaced, _SPACED, np.uint64(0))
        # Distinct keys in ascending order: their searches stay near each other in memory.
        order = np.argsort(keys)
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), ranked[1:] != ranked[:-1])))
        own = ranked[first]
        at, size = self.table.find(own)
        if (unknown := np.flatnonzero(at < 0)).size:
            new = order[first[unknown]]
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(begin[new].tolist(), end[new].tolist())]
            pieces = [" " + w if s else w for w, s in zip(words, spaced[new].tolist())]
            if len(self.memo) > STEMS:
                self.memo.clear()
            self._encode(pieces)
            self.table.add(own[unknown], [self.memo[p] for p in pieces])
            at[unknown], size[unknown] = self.table.find(own[unknown])
        place = np.empty(len(keys), np.int64)
        place[order] = np.repeat(np.arange(len(own)), np.diff(np.append(first, len(keys))))
        at, size = at[place], size[place]
        # Each word, with the id of the line break before it if there is one.
        units, lengths = np.zeros(2 * len(at), np.int64), np.zeros(2 * len(at), np.int64)
        units[1::2], lengths[1::2] = at, size
        lengths[0::2] = before == 0x0A
        stops = np.cumsum(lengths)
        ids = self.table.flat[np.repeat(units - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)]
        bounds = np.append(2 * np.searchsorted(begin, starts), len(lengths))
        cuts = np.append(0, stops)[bounds]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


class Table:
    """Ids of known pieces by 64-bit hash: sorted arrays, a large old one and a small young one."""

    def __init__(self, line_break: bytes):
        self.line_break = np.frombuffer(line_break, "<u4")
        self._empty()

    def _empty(self) -> None:
        self.flat = np.zeros(1 << 16, "<u4")
        self.flat[: len(self.line_break)] = self.line_break  # at 0
        self.used = len(self.line_break)
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.old, self.young = none, none

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in flat, or -1; number of ids) of each key."""
        at, size = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for known, places, sizes in (self.old, self.young):
            if len(known):
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[i] == keys
                at[hit], size[hit] = places[i[hit]], sizes[i[hit]]
        return at, size

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        sizes = np.asarray([len(x) // 4 for x in ids], np.int64)
        new = np.frombuffer(b"".join(ids), "<u4")
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), "<u4")])
        self.flat[self.used : self.used + len(new)] = new
        places = self.used + np.cumsum(sizes) - sizes
        self.used += len(new)
        self.young = _merged(self.young, (keys, places, sizes))
        if len(self.young[0]) > YOUNG_PIECES:
            self.old, self.young = _merged(self.old, self.young), tuple(x[:0] for x in self.young)

    def trim(self) -> None:
        """Starts again when full."""
        if len(self.old[0]) > MEMO_PIECES:
            self._empty()


def _merged(a: tuple, b: tuple) -> tuple:
    order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
    return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))


def _is_plain(text: str) -> bool:
    """Whether spaces and line breaks stand alone between visible characters, and there is no other white space."""
    if text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    return not any(c in text for c in (_ASCII_SPACES if text.isascii() else _SPACES))


def split(text: str) -> list[str]:
    """Pieces whose ids don't depend on their neighbours; joined they are the text."""
    if not text:
        return []
    out: list[str] = []
    for k, part in enumerate(text.split(" ")):
        piece = " " + part if k else part
        if out and k and (not part or part[0].isspace() or not out[-1] or out[-1][-1].isspace()):
            out[-1] += piece  # white space of more than one character stays whole
        elif "\n" in part:
            out.extend(_lines(piece))
        elif piece:
            out.append(piece)
    return out


def _lines(piece: str) -> list[str]:
    """Splits at lone line breaks between visible characters: before, the break, after."""
    out = [""]
    lines = piece.split("\n")
    for k, line in enumerate(lines):
        if not k:
            out[-1] += line
        elif out[-1] and not out[-1][-1].isspace() and line and not line[0].isspace():
            out.extend(("\n", line))
        else:
            out[-1] += "\n" + line
    return [x for x in out if x]


def encoded(encode, ids, texts, size: int = 256):
    """(id, ids of the text) of an Arrow batch's rows, a few documents at a time to keep memory small."""
    for at in range(0, len(texts), size):
        yield from zip(ids.slice(at, size).to_pylist(), encode(texts.slice(at, size).to_pylist()))


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
