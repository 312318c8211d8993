"""Token ids of whole texts, with the ids of pieces of text remembered.

Both tokenizers cut a text into pieces (a word, digits, signs, white space) before they merge, so the
ids of a text are the ids of its pieces one after the other. ``WordEncoder`` cuts texts with the
tokenizer's own pattern, numbers the distinct pieces, asks the ``tokenizers`` library once per new
piece (many as one text) and puts the ids of a text together by number.

The pattern is applied here to texts of Latin-1 characters only, on which lower-casing, letters,
digits and white space mean the same in every library; other texts are cut at blanks, which is
certain for any text, and texts for which no cut is certain go to the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

from .common import give_back

#: A worker remembers pieces of about so many bytes in all (bounds memory, changes no result) ...
REMEMBERED_BYTES = 48 << 20
#: ... and, between tasks and when that is full, the most frequent ones only.
FREQUENT = 40_000
#: What a remembered piece takes beside its characters and ids: its string, number and offsets.
OVERHEAD = 150
#: Pieces given to the library as one text.
JOINED = 100
#: Marks a piece that the tokenizer may cut further (no other piece holds this character).
UNCUT = "\x1c"

# FIXED VALUES: the patterns by which the two tokenizers cut a text, with their classes of letters
# and digits spelt out for Latin-1.
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
WORD_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+"
BYTE_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\\s{LETTERS}{DIGITS}]+|\\s+(?!\\S)|\\s+"

_ENCODERS: dict[tuple[str, bool], "WordEncoder"] = {}


def encoder(path: str, spaces_kept: bool) -> "WordEncoder":
    """The worker's encoder for a tokenizer file."""
    if (path, spaces_kept) not in _ENCODERS:
        _ENCODERS[path, spaces_kept] = WordEncoder(path, spaces_kept)
    return _ENCODERS[path, spaces_kept]


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class WordEncoder:
    """Encodes texts to bytes of little-endian unsigned 32-bit ids.

    ``spaces_kept``: True for byte-level tokenizers that put a space before a word into its first
    token; False for tokenizers that drop white space and mark the end of a piece.
    """

    #: white space other than blank and line end, or two of those in a row: the cut is left to the library
    OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    IN_A_ROW = ("  ", " \n", "\n ", "\n\n")
    #: not Latin-1, or white space to one library and none to another
    UNSURE = re.compile("[^\0-\x1b\x20-\xff]")

    def __init__(self, path: str, spaces_kept: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library, self.spaces_kept = Tokenizer.from_file(path), spaces_kept
        # the same model for pieces that are cut and lower-cased already: it need only part them
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        parts = pre_tokenizers.Split(" ", "merged_with_next") if spaces_kept else pre_tokenizers.WhitespaceSplit()
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [parts, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        folded = self.library.normalizer
        self.lower = not spaces_kept and folded is not None and folded.normalize_str("Ab") == "ab"
        self.cut = re.compile(BYTE_PATTERN if spaces_kept else WORD_PATTERN).findall
        names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        # byte-level vocabularies write the blank as this letter: such ids begin a piece; the others
        # mark the end of one
        self.edge = np.array([n.startswith("Ġ") if spaces_kept else n.endswith("</w>") for n in names], bool)
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.held = Numbers(), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.asked, self.flat = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _ids(self, texts: list[str], library=None) -> list[np.ndarray]:
        encoded = (library or self.library).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in encoded]

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces whose ids, joined, are the text's; None if it has to be encoded whole."""
        if "<|" in text:  # may hold the text of a special token
            return None
        if not self.UNSURE.search(text):
            return self.cut(text.lower() if self.lower else text)
        if not self.spaces_kept:
            return [UNCUT + p for p in text.replace("\n", " ").split(" ") if p]
        if any(x in text for x in self.IN_A_ROW) or self.OTHER_SPACE.search(text):
            return None
        # a piece is a blank with what follows it, or a line end with what follows it
        first, *others = text.replace("\n", " \n").split(" ")
        return [UNCUT + first, *(UNCUT + p if p[:1] == "\n" else f"{UNCUT} {p}" for p in others)]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces, asked for many as one text where they can be told apart again."""
        if self.spaces_kept:
            joinable = [k for k, p in enumerate(pieces) if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        else:
            joinable = [k for k, p in enumerate(pieces) if p[0] != UNCUT]
        between = "" if self.spaces_kept else " "
        start, length = np.zeros(len(pieces), np.int64), np.full(len(pieces), -1, np.int64)
        parts, at = [self.flat], len(self.flat)
        groups = [joinable[k:k + JOINED] for k in range(0, len(joinable), JOINED)]
        for group, ids in zip(groups, self._ids([between.join([pieces[k] for k in g]) for g in groups], self.merges),
                              strict=True):
            edges = np.flatnonzero(self.edge[ids])
            # an edge begins a piece of a byte-level tokenizer and ends one of the other
            begin = edges if self.spaces_kept else np.concatenate([[0], edges[:-1] + 1])
            end = np.concatenate([edges[1:], [len(ids)]]) if self.spaces_kept else edges + 1
            if len(edges) == len(group) and begin[0] == 0 and end[-1] == len(ids):
                start[group], length[group] = at + begin, end - begin
                parts.append(ids)
                at += len(ids)
        rest = np.flatnonzero(length < 0).tolist()
        for k, ids in zip(rest, self._ids([pieces[k].removeprefix(UNCUT) for k in rest]), strict=True):
            start[k], length[k] = at, len(ids)
            parts.append(ids)
            at += len(ids)
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])
        self.asked = np.concatenate([self.asked, np.zeros(len(pieces), np.int64)])
        self.flat = np.concatenate(parts)
        self.held += OVERHEAD * len(pieces) + sum(map(len, pieces)) + 4 * int(length.sum())

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > REMEMBERED_BYTES:
            self._shrink()
        known, numbers = len(self.numbers), self.numbers
        cut = [self._pieces(t) for t in texts]
        coded = [None if p is None else np.fromiter(map(numbers.__getitem__, p), np.int64, len(p)) for p in cut]
        if len(numbers) > known:
            self._learn(list(islice(numbers, known, None)))
        whole = iter(self._ids([t for t, p in zip(texts, cut, strict=True) if p is None]))
        out = []
        for codes in coded:
            if codes is None:
                out.append(next(whole).tobytes())
                continue
            np.add.at(self.asked, codes, 1)
            length = self.length[codes]
            end = np.cumsum(length)
            places = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[codes] - end + length, length)
            out.append(self.flat[places].tobytes())
        return out

    def forget(self) -> None:
        """At the end of a task keep the most frequent pieces only (the worker lives on)."""
        self._shrink()
        give_back()

    def _shrink(self) -> None:
        keep = np.sort(np.argsort(-self.asked, kind="stable")[:FREQUENT])
        pieces, start, length, flat = list(self.numbers), self.start, self.length, self.flat
        short = [k for k in keep.tolist() if len(pieces[k]) <= 32 and self.asked[k] > 1]
        self._clear()
        for k in short:
            self.numbers[pieces[k]] = len(self.numbers)
        self.length = length[short]
        self.start = np.cumsum(self.length) - self.length
        self.asked = np.zeros(len(short), np.int64)
        self.flat = np.concatenate([np.zeros(0, "<u4"), *(flat[start[k]:start[k] + length[k]] for k in short)])
        self.held = OVERHEAD * len(short) + sum(len(pieces[k]) for k in short) + self.flat.nbytes
