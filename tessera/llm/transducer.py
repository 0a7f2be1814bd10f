"""BPE as a streaming transducer with bounded lookahead, and its decoder.

``sufficient_lookahead`` computes from the merge list how many symbols after a
token's end can still change it. A merge over a boundary depends on what lies
right of it only through the token that it takes in; that token can be
prevented only by an earlier-ranked merge over its own right end, and so on.
Ranks strictly fall along such a chain, so one pass over the merges in rank
order gives the longest chain. ``Transducer`` keeps a buffer of a few times
this bound, merges it, and emits each token that ends at least that far from
the buffer's end; the rest stays as symbols. A token boundary that is final
splits the problem, so re-merging the rest alone is exact, and memory does not
depend on the length of the text or of a pre-token.

``Decoder`` turns ids into text through a byte-to-text state machine that
holds at most an unfinished UTF-8 sequence.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import vocab
from .scratch import ship


#: Entries of the codec's memo: each holds ids and text.
MEMO_ENTRIES = 350_000
#: Bytes of a chunk whose tokens are no longer listed at once.
LONG_CHUNK = 1 << 14


def sufficient_lookahead(merges: Iterable[tuple[int, int, int]]) -> int:
    """Symbols after a token's end that decide whether it is final; 1 at least."""
    length: dict[int, int] = {}
    made: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
    by_left: dict[int, tuple[list[int], list[int]]] = {}  # left -> (ranks, running maximum of their reach)
    most = 1
    for rank, (left, right, token) in enumerate(merges):
        reach, spine, below = 0, right, rank
        while True:  # the tokens that end where ``right`` ends, and the rank that takes each in
            ranks, best = by_left.get(spine, ((), ()))
            k = bisect.bisect_left(ranks, below)
            if k:
                reach = max(reach, best[k - 1])
            if spine not in made:
                break
            below, _, spine = made[spine]
        reach += length.get(right, 1)
        ranks, best = by_left.setdefault(left, ([], []))
        ranks.append(rank)
        best.append(max(reach, best[-1]) if best else reach)
        most = max(most, reach)
        if token not in made:
            made[token] = (rank, left, right)
            length[token] = length.get(left, 1) + length.get(right, 1)
    return most


class Transducer:
    """Encodes pre-tokens by the merge list, rank by rank and left to right."""

    def __init__(self, words: vocab.WordVocabulary):
        self.words = words
        self.rules = {(a, b): (rank, c) for rank, (a, b, c) in reversed(list(enumerate(words.merges)))}
        self.lookahead = sufficient_lookahead(words.merges)
        self.sizes: dict[int, int] = dict.fromkeys(words.inner + words.final, 1)
        for a, b, c in words.merges:
            self.sizes.setdefault(c, self.sizes[a] + self.sizes[b])

    def merge(self, ids: list[int]) -> list[int]:
        """All merges within a list of symbols."""
        if len(ids) > 48:
            return self._merge_long(ids)
        rules = self.rules
        found = [rules.get(pair) for pair in zip(ids, ids[1:])]
        while True:
            best = min((f[0], k) for k, f in enumerate(found) if f) if any(found) else None
            if best is None:
                return ids
            k = best[1]
            ids[k : k + 2] = [found[k][1]]
            del found[k]
            if k:
                found[k - 1] = rules.get((ids[k - 1], ids[k]))
            if k < len(found):
                found[k] = rules.get((ids[k], ids[k + 1]))

    def _merge_long(self, ids: list[int]) -> list[int]:
        rules, n = self.rules, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], k, r[1], ids[k], ids[k + 1]) for k in range(n - 1) if (r := rules.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, token, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j] = token, -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
                if r := rules.get((token, ids[after[k]])):
                    heapq.heappush(heap, (r[0], k, r[1], token, ids[after[k]]))
            if before[k] >= 0 and (r := rules.get((ids[before[k]], token))):
                heapq.heappush(heap, (r[0], before[k], r[1], ids[before[k]], token))
        return [i for i in ids if i >= 0]

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of one pre-token's symbols, each as soon as it is stable."""
        hold = 4 * self.lookahead + 64
        buffer: list[int] = []
        for s in symbols:
            buffer.append(s)
            if len(buffer) >= hold:
                tokens, end, done = self.merge(list(buffer)), 0, 0
                for t in tokens:
                    if end + self.sizes[t] > len(buffer) - self.lookahead:
                        break
                    end += self.sizes[t]
                    done += 1
                if not done:
                    raise AssertionError("no stable token within the sufficient lookahead")
                yield from tokens[:done]
                del buffer[:end]
        yield from self.merge(buffer)

    def pre_token(self, word: bytes) -> list[int]:
        if not word:
            return []
        inner = self.words.inner
        if len(word) <= 64:
            symbols = [inner[b] for b in word]
            symbols[-1] = self.words.final[word[-1]]
            return self.merge(symbols)
        last = len(word) - 1
        return list(self.stream(self.words.final[b] if k == last else inner[b] for k, b in enumerate(word)))

    def batches(self, chunk: bytes, size: int = 4096) -> Iterator[list[int]]:
        """Ids of a chunk of any length, some at a time; beside the chunk itself, memory is constant."""
        out: list[int] = []
        for p in self.words.iter_pre_tokens(chunk):
            if isinstance(p, int):
                out.append(p)
            elif len(p) <= 64:
                out += self.pre_token(p)
            else:
                last = len(p) - 1
                for t in self.stream(self.words.final[b] if k == last else self.words.inner[b] for k, b in enumerate(p)):
                    out.append(t)
                    if len(out) >= size:
                        yield out
                        out = []
            if len(out) >= size:
                yield out
                out = []
        if out:
            yield out

    def chunk(self, chunk: bytes) -> list[int]:
        """Ids of a space-separated chunk."""
        out: list[int] = []
        for p in self.words.pre_tokens(chunk):
            if isinstance(p, int):
                out.append(p)
            else:
                out += self.pre_token(p)
        return out


class Decoder:
    """Ids to text, piece by piece.

    ``joiner`` is what the library writes between tokens: a space where the
    file names no decoder, nothing where it names the byte-level one
    (``byte_level``: token characters stand for bytes).
    """

    def __init__(self, strings: dict[int, str], byte_level: bool = False):
        if byte_level:
            of = {c: b for b, c in enumerate(vocab.byte_chars())}
            self.bytes = {i: bytes(of[c] for c in s) if all(c in of for c in s) else s.encode() for i, s in strings.items()}
        else:
            self.bytes = {i: s.encode() for i, s in strings.items()}
        self.joiner = b"" if byte_level else b" "
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        data = self.joiner.join(self.bytes[i] for i in ids)
        return self.feed_bytes(data) if data else ""

    def feed_bytes(self, data: bytes) -> str:
        if self.begun and self.joiner:
            data = self.joiner + data
        self.begun = True
        return self.machine.decode(data)

    def finish(self) -> str:
        self.begun = False
        text = self.machine.decode(b"", True)
        self.machine.reset()
        return text


class _Codec:
    """A worker's transducer with a memo: chunk -> (tokens, ids as decimal text, decoded bytes)."""

    def __init__(self, path: str):
        words = vocab.load(path)
        transducer = Transducer(words)
        decoder = Decoder(words.strings)
        self.decoder = decoder

        def part(p: bytes | int) -> tuple[int, bytes, bytes]:
            ids = [p] if isinstance(p, int) else transducer.pre_token(p)
            return len(ids), b" ".join([b"%d" % i for i in ids]), decoder.joiner.join([decoder.bytes[i] for i in ids])

        def join(parts: list[tuple[int, bytes, bytes]]) -> tuple[int, bytes, bytes]:
            return sum(p[0] for p in parts), b" ".join([p[1] for p in parts]), decoder.joiner.join([p[2] for p in parts])

        self.transducer = transducer
        self.memo = vocab.ChunkMemo(words, part, join, MEMO_ENTRIES)

    def _entries(self, words: list[bytes]) -> Iterator[list[tuple[int, bytes, bytes]]]:
        """The chunks' entries, in parts; a long chunk's in many, as its tokens become stable."""
        if max(map(len, words), default=0) <= LONG_CHUNK:
            yield [e for e in map(self.memo.__getitem__, words) if e[0]]
            return
        for chunk in words:
            if len(chunk) <= LONG_CHUNK:
                yield [e for e in (self.memo[chunk],) if e[0]]
            else:
                for ids in self.transducer.batches(chunk):
                    yield [(len(ids), b" ".join([b"%d" % i for i in ids]), self.decoder.joiner.join([self.decoder.bytes[i] for i in ids]))]

    def digest(self, text: bytes | None) -> tuple[int, str, str]:
        """(tokens, sha256 of the ids, sha256 of the decoded text), in slices of the text."""
        n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
        begun = False
        for words in vocab.pieces_of(text or b""):
            for entries in self._entries(words):
                if not entries:
                    continue
                counts, ids, data = zip(*entries)
                n += sum(counts)
                if begun:
                    ids_sha.update(b" ")
                ids_sha.update(b" ".join(ids))
                text_sha.update(self.decoder.feed_bytes(b" ".join(data)).encode())
                begun = True
        text_sha.update(self.decoder.finish().encode())
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


_codecs: dict[str, _Codec] = {}


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: encoded and decoded in one pass, without a shuffle.

    Null text counts as empty (no tokens, digests of nothing); a text of any
    length, blanks or not, needs little memory beside itself; repeated rows
    give repeated results.
    """
    ship(docs.sparkSession)
    path = path or vocab.vocabulary_path()

    def run(batches):
        if path not in _codecs:
            _codecs[path] = _Codec(path)
        codec = _codecs[path]
        for batch in batches:
            rows = [codec.digest(t) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            n, ids, text = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
