"""A public BPE vocabulary file, split into the parts that the operators need.

White space never lies inside a pre-token, and the normaliser acts on each
character alone (NFC never composes over white space), so a text's tokens are
those of its space-separated chunks, one after the other. That makes a chunk
the unit of every memo here.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .scratch import release

#: Entries of a worker's memo.
MEMO_ENTRIES = 600_000
#: The splitting pattern on lower-case ASCII bytes.
ASCII_PATTERN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class WordVocabulary:
    """Merges, ids and splitting rules of a word-level BPE file (``end_of_word_suffix``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings: dict[int, str] = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.specials.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges: list[tuple[int, int, int]] = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in merges]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.ascii_splits = self.pattern.pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        chars = byte_chars()
        self.inner = [self.ids[c] for c in chars]
        self.final = [self.ids[c + self.suffix] for c in chars]

    def normalise(self, part: str) -> str:
        part = unicodedata.normalize("NFC", part)
        return "".join(map(str.lower, part)) if "Σ" in part else part.lower()

    def pre_tokens(self, chunk: bytes) -> list[bytes | int]:
        """UTF-8 pre-tokens of a chunk; an int is a special token's id."""
        if chunk.isascii():
            low = chunk.lower()
            if low.isalpha():
                return [low]
            if self.ascii_splits and b"<|" not in low:
                return ASCII_PATTERN.findall(low)
        return list(self.iter_pre_tokens(chunk))

    def iter_pre_tokens(self, chunk: bytes):
        """As ``pre_tokens``, one by one: of a long chunk no list is made."""
        text = chunk.decode("utf-8", "replace")
        if self.special_pattern is None or "<|" not in text:
            for p in self.pattern.finditer(self.normalise(text)):
                yield p.group().encode()
            return
        at = 0
        for special in [*self.special_pattern.finditer(text), None]:
            part = text[at : special.start()] if special else text[at:]
            if part:
                for p in self.pattern.finditer(self.normalise(part)):
                    yield p.group().encode()
            if special:
                yield self.specials[special.group()]
                at = special.end()


_loaded: dict[str, WordVocabulary] = {}


def load(path: str) -> WordVocabulary:
    """The vocabulary, read once per worker process."""
    if path not in _loaded:
        _loaded[path] = WordVocabulary(path)
    return _loaded[path]


_library: dict[str, object] = {}


def library(path: str):
    """The tokenizers library's object for the file, on one thread, one per worker process."""
    if path not in _library:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _library[path] = tokenizer
    return _library[path]


def unload() -> None:
    """Empties what ``load`` and ``library`` keep in this process."""
    _loaded.clear()
    _library.clear()


_holders: dict[str, object] = {}


def only(owner: str, forget) -> None:
    """Lets a worker remember for one operator at a time: workers outlive stages, and what others left is emptied by their ``forget``."""
    if owner not in _holders:
        for empty in _holders.values():
            empty()
        _holders.clear()
        release()
        _holders[owner] = forget


def slices(batch: pa.RecordBatch, column: int, limit: int = 2 << 20):
    """A batch in slices of ``limit`` bytes of a text column at most besides their first row, so that what is made of one stays small."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64) + 64) // limit)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            yield batch.slice(i, j - i)


def sliced(batches, column: int):
    """``slices`` of all batches; unused memory goes back to the system after each batch."""
    for batch in batches:
        yield from slices(batch, column)
        batch = None
        release()


_BLANK = re.compile(rb"[\t-\r ]")


def pieces_of(text: bytes, limit: int = 1 << 20):
    """Lists of a text's space-separated chunks, from slices of ``limit`` bytes that go on to the next white space.

    Linear in the text: a chunk that is longer than the limit is a slice of its own.
    """
    if len(text) <= limit:
        yield text.split()
        return
    at = 0
    while at < len(text):
        gap = _BLANK.search(text, at + limit)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()
        at = end


class ChunkMemo(dict):
    """chunk -> entry, for chunks met lately in this worker.

    ``encode`` gives a pre-token's (or special id's) part, ``join`` the entry
    of several parts. Two generations, the older one dropped when the younger
    is full, so frequent chunks stay and memory is bounded.
    """

    def __init__(self, words: WordVocabulary, encode, join, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.words, self.encode, self.join, self.entries = words, encode, join, entries
        self.old: dict = {}
        self.known: dict = {}
        self.old_known: dict = {}

    def _part(self, pre_token):
        got = self.old_known.get(pre_token)
        if got is None:
            got = self.encode(pre_token)
        if isinstance(pre_token, int) or len(pre_token) <= 64:
            if len(self.known) >= self.entries // 2:
                self.old_known, self.known = self.known, {}
            self.known[pre_token] = got
        return got

    def __missing__(self, chunk: bytes):
        entry = self.old.get(chunk)
        if entry is None:
            get = self.known.get
            parts = []
            for p in self.words.pre_tokens(chunk):
                got = get(p)
                parts.append(self._part(p) if got is None else got)
            entry = parts[0] if len(parts) == 1 else self.join(parts)
        if len(chunk) <= 64:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[chunk] = entry
        return entry


def library_encoder(path: str):
    """ids of a normalised pre-token by the tokenizers library's own merge model."""
    tokenize, shown = library(path).model.tokenize, byte_chars()

    def encode(pre_token: bytes) -> list[int]:
        text = pre_token.decode("ascii", "replace")
        if not (text.isascii() and text.isprintable()):
            text = "".join([shown[b] for b in pre_token])
        return [t.id for t in tokenize(text)]

    return encode
