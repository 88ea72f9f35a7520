"""Token ids of whole texts by a public tokenizer, a column of texts at a time.

Both tokenizers used here split a text at every blank that follows a character other than a blank:
no token reaches over it, and what stands before it does not change what follows. So a text's ids
are those of its pieces. Arrow splits the texts of a slice and finds its distinct pieces; those made of
letters and then signs have two parts, which are looked up as a column too. Only parts that the
worker does not know yet go through the tokenizer's merges; other pieces are split by the tokenizer's
own pattern first. Ids are then put together by index. Texts to which the rule does not apply (two
blanks in a row, strings of special tokens) and pieces with characters outside the Latin blocks are
encoded by the tokenizer as they are; so are special tokens' strings, which get ids of their own.

What a worker keeps is bounded: ``KNOWN_PARTS`` parts and ``KNOWN_CHARS`` characters of them.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_PARTS = 200_000  # what a Python worker keeps starts anew beyond that
KNOWN_CHARS = 8_000_000
SLICE = 2 << 20  # bytes of text encoded at once
LONG = 1 << 20  # characters; a longer text is encoded in parts, cut at blanks

# The tokenizers' own patterns.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS = ".,;:!?*#$%&|"  # of one kind to either pattern
# Letters of Latin-1, whose lower case is one letter, and then signs.
SIMPLE = rf"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[{SIGNS}]*)$"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others for those from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


class Encoder:
    """``blank``: a piece keeps the blank before it (byte-level), else blanks mean nothing."""

    def __init__(self, path: str, blank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.model._resize_cache(0)
        self.parts_of = regex.compile(BYTE_PATTERN if blank else WORD_PATTERN).findall
        self.letters = byte_letters()
        self.blank = " " if blank else ""
        self._forget()

    def _forget(self) -> None:
        """``known``: number of a part; its ids are ``ids[begins[number] : begins[number + 1]]``."""
        self.known: dict[str, int] = {"": 0}
        self.ids, self.begins, self.chars = array("I"), array("q", [0, 0]), 0

    def _keep(self, texts: list[str], ids: list[list[int]]) -> range:
        first = len(self.begins) - 1
        numbers = range(first, first + len(texts))
        self.known.update(zip(texts, numbers))
        for some in ids:
            self.ids.extend(some)
            self.begins.append(len(self.ids))
        self.chars += sum(map(len, texts))
        return numbers

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts of the pattern, in normal form."""
        tokenize, letters = self.model.tokenize, self.letters
        spelled = [p.replace(" ", "Ġ") if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(letters) for p in parts]
        return [[t.id for t in tokenize(x)] for x in spelled]

    def _piece(self, piece: str) -> list[int]:
        if not piece.isascii():
            if max(piece) >= "ɐ":
                return self.whole(piece)
            if not self.blank:
                piece = unicodedata.normalize("NFC", piece)
        if not self.blank:
            piece = piece.lower()
        out: list[int] = []
        for part in self.parts_of(piece):
            number = self.known.get(part)
            if number is None:
                (number,) = self._keep([part], self._parts([part]))
            out += self.ids[self.begins[number] : self.begins[number + 1]]
        return out

    def _numbers(self, parts: pa.Array, prefix: str) -> np.ndarray:
        """Numbers of distinct parts, the new ones tokenised."""
        texts = [prefix + p if p else p for p in parts.to_pylist()] if prefix else parts.to_pylist()
        out = np.array(list(map(self.known.get, texts, repeat(-1))), np.int64)
        new = np.flatnonzero(out < 0)
        some = [texts[k] for k in new.tolist()]
        out[new] = self._keep(some, self._parts(some))
        return out

    def _pieces(self, pieces: pa.Array, prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """For distinct pieces the numbers of their one or two parts (0: none)."""
        first, second = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        found = pc.extract_regex(pieces, SIMPLE)
        simple = found.is_valid().to_numpy(zero_copy_only=False)
        some = found.filter(pa.array(simple))
        core, tail = some.field("core"), some.field("tail").dictionary_encode()
        core = (core if self.blank else pc.utf8_lower(core)).dictionary_encode()
        first[simple] = self._numbers(core.dictionary, prefix)[core.indices.to_numpy(zero_copy_only=False)]
        second[simple] = self._numbers(tail.dictionary, "")[tail.indices.to_numpy(zero_copy_only=False)]
        others = np.flatnonzero(~simple)
        for at, piece in zip(others.tolist(), pieces.take(pa.array(others)).to_pylist()):
            # Under a key of their own: such a piece may also be the text of a part.
            key = f"\0{prefix}{piece}"
            number = self.known.get(key)
            if number is None:
                (number,) = self._keep([key], [self._piece(prefix + piece)])
            first[at] = number
        return first, second

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column (NULL: empty) in a row, and where those of each end."""
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        if not len(sizes) or sizes.max() <= LONG:
            return self._column(texts)
        rows, owners = [], []
        for k, text in enumerate(texts.to_pylist()):
            parts = [text] if "<|" in text else list(_cut(text))
            rows += parts
            owners += [k] * len(parts)
        ids, ends = self._column(pa.array(rows, pa.large_string()))
        last = np.searchsorted(np.array(owners), np.arange(len(sizes)), side="right") - 1
        return ids, ends[last]

    def _column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KNOWN_PARTS or self.chars > KNOWN_CHARS:
            self._forget()
        odd = pc.match_substring(texts, "<|")
        if self.blank:
            odd = pc.or_(odd, pc.match_substring(texts, "  "))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        lists = pc.split_pattern(plain if self.blank else pc.replace_substring(plain, "\n", " "), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first, second = self._pieces(coded.dictionary, self.blank)
        if self.blank and len(plain):  # the first piece of a text has no blank before it
            heads = np.cumsum(counts) - counts
            distinct, inverse = np.unique(at[heads], return_inverse=True)
            more = self._pieces(coded.dictionary.take(pa.array(distinct)), "")
            at[heads] = len(first) + inverse
            first, second = np.concatenate([first, more[0]]), np.concatenate([second, more[1]])
        begins, pool = np.array(self.begins, np.int64), np.array(self.ids, np.uint32)
        sizes = np.diff(begins)
        # Ids of the distinct pieces in a row, then those of all pieces.
        both = np.stack([first, second], 1).ravel()
        pool = _take(pool, begins[both], sizes[both])
        length = sizes[first] + sizes[second]
        ids = _take(pool, (np.cumsum(length) - length)[at], length[at])
        per_text = np.zeros(len(texts), np.int64)
        run = np.concatenate([[0], np.cumsum(length[at])])
        ends = np.cumsum(counts)
        per_text[~odd] = run[ends] - run[ends - counts]
        if odd.any():
            where = np.flatnonzero(odd)
            whole = [np.array(self.whole(x), np.uint32) for x in texts.take(pa.array(where)).to_pylist()]
            per_text[where] = [len(x) for x in whole]
            out = np.empty(int(per_text.sum()), np.uint32)
            mine = np.repeat(odd, per_text)
            out[mine], out[~mine] = np.concatenate(whole), ids
            ids = out
        return ids, np.cumsum(per_text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, ends = self.column(pa.array(texts, pa.string()))
        return [x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])] if texts else []


def _cut(text: str) -> Iterator[str]:
    """Parts of a long text; each but the first begins with a blank after another character."""
    at = 0
    while len(text) - at > LONG:
        end = text.find(" ", at + LONG)
        while end > 0 and text[end - 1] == " ":
            end = text.find(" ", end + 1)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _take(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of the pool one after the other."""
    ends = np.cumsum(sizes)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text; a longer text stands alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def closed(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` behind the ids of each text."""
    ends = ends + np.arange(1, len(ends) + 1)
    out = np.empty(len(ids) + len(ends), np.uint32)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last], out[~last] = end_id, ids
    return out, ends


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, blank: bool) -> Encoder:
    """One encoder for each Python worker, kept between its tasks."""
    if (path, blank) not in _encoders:
        _encoders[path, blank] = Encoder(path, blank)
    return _encoders[path, blank]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
