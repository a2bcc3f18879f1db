"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding with a state machine.

Merges are applied in the order of the list. A token boundary near the end of what has been read can still be undone by
what follows, but only through a chain of merges in which each one takes the boundary of the one before to the left.
`lookahead` bounds the symbols that such a chain can span, for the given list. So a word is read into a window; tokens
that end at least that many symbols before the window's end are final and emitted, and the rest waits for more. A final
boundary is never crossed by a merge, so what follows it is encoded on its own. The window's size does not depend on the
text. Short words are encoded whole and remembered, up to a limit.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quern.llm.columns import add_from_batches

SEPARATORS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = regex.compile(f"[{SEPARATORS}]+")
#: Characters that Python splits at, but which are no white space to the tokenizer.
_NOT_SPACES = regex.compile("[\x1c-\x1f]")


#: Words up to this many symbols are merged by looking through all pairs each time, longer ones with a heap.
SHORT = 24
#: Longer words are streamed, and not remembered.
LONG = 256
_NEVER = 1 << 60


class Remembered:
    """A bounded memory of two generations: when the young one is full it takes the place of the old one."""

    def __init__(self, limit: int):
        self.young: dict = {}
        self.old: dict = {}
        self.limit = limit

    def put(self, key, value):
        if len(self.young) >= self.limit:
            self.old = dict(self.young)
            self.young.clear()
        self.young[key] = value
        return value

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is one, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    fresh = iter(range(256, 512))
    return [chr(b if b in printable else next(fresh)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]], size) -> int:
    """Symbols that a chain of merges can carry a boundary to the left.

    A merge (u, v) carries a boundary between u and v over u. The next one, later in the list, takes its right part at the
    new boundary, so that part begins with u or with the merged token. The bound is the heaviest chain, found in one pass
    over the list: for each token, the heaviest chain so far that ends with it on the left.
    """
    parts = {u + v: (u, v) for u, v in merges}
    heaviest: dict[str, int] = {}
    best = 0
    for u, v in merges:
        chain, begins = 0, v
        while True:
            chain = max(chain, heaviest.get(begins, 0))
            if begins not in parts:
                break
            begins = parts[begins][0]
        total = chain + size(u)
        heaviest[u] = max(heaviest.get(u, 0), total)
        best = max(best, total)
    return best


class BytePairs:
    """A merge list with its vocabulary, and the pieces of text that it is applied to.

    Follows the tokenizer file: special strings are found first; what lies between is normalised (NFC, lower case) and cut
    at white space and by the file's pattern; bytes become symbols; the last symbol of a piece has an end mark. Words and
    their tokens are remembered, 2 * `limit` of each at most, so memory is bounded. Which characters are letters or numbers
    is up to the installed libraries: those added after Unicode 16 may be cut otherwise than by the tokenizer's own.
    """

    def __init__(self, path: str, limit: int = 150_000, chunk: int = 4096):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._check(merges)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in {**self.vocab, **self.specials}.items()}
        self.ranks = {self._pair(*(self.vocab[part] for part in pair)): i for i, pair in enumerate(merges)}
        self.made = [self.vocab[u + v] for u, v in merges]
        self.sizes = {i: self._size(t) for t, i in self.vocab.items()}
        symbols = byte_symbols()
        self.symbols = [self.vocab[c] for c in symbols]
        self.closing = {self.vocab[c]: self.vocab[c + self.end] for c in symbols}
        self.spelt = {c: b for b, c in enumerate(symbols)}
        self.packed = {i: struct.pack("<I", i) for i in self.names}
        self.spaced = {i: (" " + t).encode("utf-8") for i, t in self.names.items()}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or "(?!)")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.lookahead = lookahead(merges, self._size)
        self.window = self.lookahead + chunk
        self.runs, self.words = Remembered(limit), Remembered(limit)

    @staticmethod
    def _check(merges) -> None:
        """The bound holds for lists in which every part of a merge is made by an earlier one, and made by one only."""
        made: dict[str, int] = {}
        for i, (u, v) in enumerate(merges):
            if u + v in made:
                raise ValueError(f"two merges make {u + v}")
            made[u + v] = i
        for i, pair in enumerate(merges):
            if any(made.get(part, -1) >= i for part in pair):
                raise ValueError(f"{pair} comes before a merge that makes its part")

    def _size(self, token: str) -> int:
        bare = token.removesuffix(self.end) if self.end and token != self.end else token
        return len(bare)

    @staticmethod
    def _pair(a: int, b: int) -> int:
        return a << 20 | b

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to symbols: always the earliest in the list, leftmost first."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        get, made = self.ranks.get, self.made
        found = [get(a << 20 | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while found and (rank := min(found)) != _NEVER:
            i = found.index(rank)
            ids[i] = made[rank]
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 20 | ids[i], _NEVER)
            if i < len(found):
                found[i] = get(ids[i] << 20 | ids[i + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of (rank, place)."""
        n, get = len(ids), self.ranks.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank, i) for i in range(n - 1) if (rank := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        alive: list[int | None] = list(ids)

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (rank := get(alive[i] << 20 | alive[j])) is not None:
                heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if alive[i] is None or j < 0 or get(alive[i] << 20 | alive[j]) != rank:
                continue
            alive[i], alive[j] = self.made[rank], None
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
            push(i, k)
            push(before[i], i)
        return [t for t in alive if t is not None]

    def stream(self, symbols: Iterator[int]) -> Iterator[int]:
        """Tokens of one word from its symbols, emitted once stable; at most a window of symbols is held.

        The last symbol read is held back, as it has the end mark if nothing follows.
        """
        held: list[int] = []
        for symbol in symbols:
            held.append(symbol)
            if len(held) > self.window:
                done = 0
                for token in self.merge(held[:-1]):
                    if done + self.sizes[token] > len(held) - 1 - self.lookahead:
                        break
                    done += self.sizes[token]
                    yield token
                held = held[done:]
        if held:
            held[-1] = self.closing[held[-1]]
            yield from self.merge(held)

    def word_ids(self, word: str) -> list[int]:
        """Ids of one short piece."""
        table = self.symbols
        ids = [table[b] for b in word.encode("utf-8")]
        ids[-1] = self.closing[ids[-1]]
        return self.merge(ids)

    def pieces(self, chunk: str) -> Iterator[str]:
        """The pieces of a run of text without white space."""
        if chunk.isascii() and chunk.isalpha():
            return iter((chunk.lower(),))
        normal = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return (found.group() for found in self.pattern.finditer(normal))

    def chunk_ids(self, chunk: str) -> Iterator[int]:
        """Ids of a run of text without white space; long pieces are streamed."""
        for piece in self.pieces(chunk):
            if len(piece) > LONG:
                yield from self.stream(self.symbols[b] for b in piece.encode("utf-8"))
            else:
                yield from self.word_ids(piece)

    def _measure(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        return len(ids), b"".join(map(self.packed.__getitem__, ids)), b"".join(map(self.spaced.__getitem__, ids))

    def measured(self, chunk: str | int) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of ids, ids as bytes, decoded tokens each with a blank before) of a run; a long one in parts."""
        found = self.runs.get(chunk)
        if found is not None:
            return (found,)
        if isinstance(chunk, int):
            return (self.runs.put(chunk, self._measure([chunk])),)
        if len(chunk) > LONG:
            return map(self._measure, batched(self.chunk_ids(chunk), 1000))
        parts = []
        for piece in self.pieces(chunk):
            part = self.words.get(piece)
            parts.append(part if part is not None else self.words.put(piece, self._measure(self.word_ids(piece))))
        if len(parts) != 1:
            counts, packed, spaced = zip(*parts) if parts else ((), (), ())
            parts = [(sum(counts), b"".join(packed), b"".join(spaced))]
        return (self.runs.put(chunk, parts[0]),)

    def chunks(self, text: str) -> Iterator[str | int]:
        """Runs without white space, and the ids of special strings, in order."""
        at = 0
        if "<" in text:
            for found in self.special.finditer(text):
                yield from self._split(text[at : found.start()])
                yield self.specials[found.group()]
                at = found.end()
        yield from self._split(text[at:] if at else text)

    @staticmethod
    def _split(text: str) -> list[str]:
        if _NOT_SPACES.search(text):
            return [c for c in _SPACES.split(text) if c]
        return text.split()

    def encode(self, text: str) -> Iterator[int]:
        for chunk in self.chunks(text):
            if isinstance(chunk, int):
                yield chunk
            else:
                yield from self.chunk_ids(chunk)

    def decode(self, ids: Iterator[int]) -> str:
        """The tokens' names with a blank between them, as the file names no decoder."""
        return " ".join(self.names[i] for i in ids)


class ByteReader:
    """Decodes ids to text piece by piece: a state machine over the bytes that the tokens' symbols stand for.

    Its state is the beginning of an unfinished character (three bytes at most) and whether a word has just ended. Bytes
    that can begin no character become U+FFFD.
    """

    def __init__(self, pairs: BytePairs):
        import codecs

        self.pairs = pairs
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token_id: int) -> str:
        """Text that became certain with this token. A special token, and the end of a word, close what is open."""
        name = self.pairs.names[token_id]
        if token_id in self.pairs.specials.values():
            return self.state.decode(b"", True) + name
        ended = bool(self.pairs.end) and name.endswith(self.pairs.end)
        bare = name.removesuffix(self.pairs.end) if ended else name
        out = self.state.decode(bytes(self.pairs.spelt[c] for c in bare), ended)
        return out + " " if ended else out

    def finish(self) -> str:
        return self.state.decode(b"", True)


_OPEN: dict[str, BytePairs] = {}


def opened(path: str) -> BytePairs:
    """The merge list of a file, read once per Python process."""
    if path not in _OPEN:
        _OPEN[path] = BytePairs(path)
    return _OPEN[path]


def encode_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256 to every row.

    The ids of the whole text, and its decoded text, are hashed while they are made, and never held as a whole. A null text
    is empty: no tokens, and the digests of nothing. Rows that repeat are encoded alike; an empty table gives no rows;
    other columns stay, but for those with the name of an added one. `path` is the tokenizer file on every machine.
    """
    added = T.StructType([
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def encode(texts: pa.Array) -> list[pa.Array]:
        pairs = opened(path)
        totals, id_hashes, text_hashes = [], [], []
        for text in texts:
            total, ids, said, first = 0, hashlib.sha256(), hashlib.sha256(), True
            recent, run = pairs.runs.young.get, []
            for chunk in pairs.chunks(text.as_py() or ""):
                found = recent(chunk)
                for part in (found,) if found else pairs.measured(chunk):
                    run.append(part)
                    if len(run) >= 10_000:
                        total, first = _flush(run, total, ids, said, first)
                        run = []
            total, first = _flush(run, total, ids, said, first)
            totals.append(total)
            id_hashes.append(ids.hexdigest())
            text_hashes.append(said.hexdigest())
        return [pa.array(totals, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]

    return add_from_batches(docs, [text_col], added, encode)


def _flush(run, total, ids, said, first) -> tuple[int, bool]:
    if run:
        counts, packed, names = zip(*run)
        total += sum(counts)
        ids.update(b"".join(packed))
        text = b"".join(names)
        said.update(text[1:] if first else text)
        first = first and not text
    return total, first


def encode_column(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add token_ids, the ids of the whole text, to every row; null texts get an empty list."""
    schema = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def encode(texts: pa.Array) -> list[pa.Array]:
        pairs = opened(path)
        return [pa.array([list(pairs.encode(t.as_py() or "")) for t in texts], pa.list_(pa.int32()))]

    return add_from_batches(docs, [text_col], schema, encode)


def decode_column(docs: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Add decoded, the text that the ids' bytes spell, to every row; null lists give an empty text."""
    schema = T.StructType([T.StructField("decoded", T.StringType())])

    def decode(lists: pa.Array) -> list[pa.Array]:
        pairs = opened(path)
        out = []
        for ids in lists.to_pylist():
            reader = ByteReader(pairs)
            out.append("".join([*map(reader.feed, ids or ()), reader.finish()]).removesuffix(" "))
        return [pa.array(out, pa.string())]

    return add_from_batches(docs, [ids_col], schema, decode)
