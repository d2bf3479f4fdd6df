"""Byte-level BPE: corpus-level merge replay, and decoding.

A replay takes a corpus of distinct words.  An index from merge rank to the
places of its token pairs in that corpus is worked off in rank order; a merge
updates only the pairs of the two neighbours it touches.  Each word so
undergoes the merges that encoding it alone would apply, and is merged once
however often it occurs.

The corpus of one replay is what a slice of a task's documents has in words
that the task does not remember; the first slices bring most words.  One
corpus of all documents would need a shuffle of every word occurrence to give
the documents their tokens; the tokens are the same.
"""

from __future__ import annotations

import base64
import heapq
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_VOCABULARY_BYTES = 64 * 1024 * 1024
#: Bytes that the words and tokens a worker remembers may take, about; beyond that it starts afresh.
REMEMBERED_BYTES = 64 * 1024 * 1024
#: What a remembered word takes beside its characters and tokens.
_PER_WORD = 200
_SLICE_CHARS = 1_000_000
_SHIFT, _LOW = 31, (1 << 31) - 1
#: From so many places of a rank on, they are merged as arrays.
_MANY = 40


def read_ranks(path: str) -> bytes:
    """The rank file, which is broadcast; its size is checked."""
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary takes more than {MAX_VOCABULARY_BYTES} bytes")
    return content


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank; every single byte must be a token."""
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"bytes without a rank: {missing}")
    return ranks


class Replay:
    """Applies all merges of a vocabulary to a corpus of distinct words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        if max(ranks.values()) > _LOW:
            raise ValueError("the ranks are too large")
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Every token cut in two tokens: all pairs that can merge, as many as the vocabulary has cuts.
        halves = ((ranks.get(t[:i]), ranks.get(t[i:]), r) for t, r in ranks.items() for i in range(1, len(t)))
        self._pairs = {(x << _SHIFT) | y: r for x, y, r in halves if x is not None and y is not None}
        self._keys = np.array(sorted(self._pairs), np.int64)
        self._merged = np.array([self._pairs[k] for k in self._keys.tolist()], np.int32)

    def _rank(self, key: int) -> int:
        """Rank of the token that a pair (left id shifted, right id) forms, -1 if none."""
        return self._pairs.get(key, -1)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.full(len(left), -1, np.int32)
        keys = (left.astype(np.int64) << _SHIFT) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._merged[at], -1)

    def words(self, corpus: Iterable[bytes]) -> list[bytes]:
        """Token ids of each word, as packed 32-bit numbers.  A word that is a token itself is taken whole."""
        corpus = list(corpus)
        whole = [self.ranks.get(w, -1) for w in corpus]
        parts = [w for w, r in zip(corpus, whole) if r < 0]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        merged = self._replay(np.frombuffer(b"".join(parts), np.uint8), ends)
        alive = merged >= 0
        kept = merged[alive].tobytes()
        cuts = (np.concatenate(([0], np.cumsum(alive)))[np.concatenate(([0], ends))] * 4).tolist() if parts else [0]
        pieces = (kept[a:b] for a, b in zip(cuts, cuts[1:]))
        return [int(r).to_bytes(4, sys.byteorder) if r >= 0 else next(pieces) for r in whole]

    def _replay(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The token at each place after all merges, -1 at places merged away; words end before ``ends``."""
        n = len(text)
        if not n:
            return np.zeros(0, np.int32)
        # Arrays of Python's own give fast single places, views on them whole ranks.
        token = array("i", self.bytes[text].tobytes())
        word = array("i", np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0)).tobytes())
        last = np.zeros(n, bool)
        last[ends - 1] = True
        first = np.roll(last, 1)
        after = array("i", np.where(last, -1, np.arange(1, n + 1, dtype=np.int32)).astype(np.int32).tobytes())
        before = array("i", np.where(first, -1, np.arange(-1, n - 1, dtype=np.int32)).astype(np.int32).tobytes())
        v_token, v_word, v_after, v_before = (np.frombuffer(x, np.int32) for x in (token, word, after, before))
        start = np.full(n, -1, np.int32)
        inner = np.flatnonzero(~last)
        start[inner] = self._ranks(v_token[inner], v_token[inner + 1])
        pair = array("i", start.tobytes())  # rank of the pair that begins at a place
        v_pair = np.frombuffer(pair, np.int32)

        index: dict[int, list] = {}  # places by rank; entries whose pair has changed are passed over
        queue: list[int] = []

        def note(rank: int, places: list) -> None:
            if rank in index:
                index[rank] += places
            else:
                index[rank] = places
                heapq.heappush(queue, rank)

        def note_all(places: np.ndarray) -> None:
            places = places[v_pair[places] >= 0]
            places = places[np.argsort(v_pair[places], kind="stable")]
            ranks = v_pair[places]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for part in np.split(places, cuts) if len(places) else ():
                note(pair[part[0]], part.tolist())

        note_all(np.flatnonzero(start >= 0))
        while queue:
            rank = heapq.heappop(queue)
            places = index.pop(rank)
            if len(places) >= _MANY:
                many = np.unique(np.array(places, np.int32))
                many = many[v_pair[many] == rank]
                words = v_word[many]
                twice = np.zeros(len(many), bool)
                twice[1:] = words[1:] == words[:-1]
                twice[:-1] |= twice[1:]
                places, many = many[twice].tolist(), many[~twice]
                right = v_after[many]
                beyond = v_after[right]
                v_token[many], v_token[right], v_pair[right], v_after[many] = rank, -1, -1, beyond
                v_before[beyond[beyond >= 0]] = many[beyond >= 0]
                left = v_before[many]
                touched = np.concatenate((left[left >= 0], many[beyond >= 0]))
                v_pair[many[beyond < 0]] = -1
                v_pair[touched] = self._ranks(v_token[touched], v_token[v_after[touched]])
                note_all(touched)
            held = set()  # words in which a new pair now comes before the rest of this rank
            for place in sorted(places):
                if pair[place] != rank:
                    continue
                if word[place] in held:
                    note(rank, [place])
                    continue
                right = after[place]
                beyond = after[right]
                token[place], token[right], pair[right], after[place] = rank, -1, -1, beyond
                if beyond >= 0:
                    before[beyond] = place
                    new = pair[place] = self._rank((rank << _SHIFT) | token[beyond])
                    if new >= 0:
                        note(new, [place])
                        if new <= rank:
                            held.add(word[place])
                else:
                    pair[place] = -1
                left = before[place]
                if left >= 0:
                    new = pair[left] = self._rank((token[left] << _SHIFT) | rank)
                    if new >= 0:
                        note(new, [left])
                        if new <= rank:
                            held.add(word[place])
        return v_token.copy()


class _Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.replay = Replay(ranks)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Token ids of every text, as packed 32-bit numbers."""
        split = [self.split(t) for t in texts]
        if self.size > REMEMBERED_BYTES:
            self.known, self.size = {}, 0
        new = list({w for words in split for w in words if w not in self.known})
        for w, ids in zip(new, self.replay.words([w.encode() for w in new])):
            self.known[w] = ids
            self.size += len(w) + len(ids) + _PER_WORD
        return [b"".join([self.known[w] for w in words]) for words in split]


class _Decoder:
    """Tokens by their ids, as one array."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            tokens[r] = t
        self.tokens = pa.array(tokens, pa.binary())

    def decode(self, column: pa.ListArray) -> pa.Array:
        """The bytes of every list of ids; the tokens of all lists are taken at once."""
        # The values of a null list need not be empty, and a slice need not begin at its array's first value.
        column = pc.fill_null(column, pa.scalar([], column.type)) if column.null_count else column
        taken = self.tokens.take(column.flatten())
        if taken.null_count:
            raise ValueError("an id without a token")
        stops = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset : taken.offset + len(taken) + 1]
        lists = column.offsets.to_numpy()
        cuts = pa.py_buffer(np.ascontiguousarray(stops[lists - lists[0]]))
        return pa.Array.from_buffers(pa.binary(), len(column), [None, cuts, taken.buffers()[2]])


def _with_columns(df: DataFrame, keep: Sequence[str], source: str, made: T.StructType, start) -> DataFrame:
    """``keep`` columns and those of ``made``, made from ``source`` in slices of few rows.

    ``start()`` gives a task what converts a slice; nothing of it outlives the task.
    """
    schema = T.StructType([*[df.schema[c] for c in keep], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = None
        for batch in batches:
            convert = convert or start()
            lengths = batch.column(len(keep))
            lengths = pc.fill_null((pc.list_value_length if pa.types.is_list(lengths.type) else pc.binary_length)(lengths), 0)
            group = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // _SLICE_CHARS
            starts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows])).tolist()
            for at, end in zip(starts, starts[1:]):
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *convert(part.column(len(keep)))], names=schema.names)

    return df.select(*keep, F.col(source).alias("_source")).mapInArrow(run, schema)


def encode(
    df: DataFrame, ranks: bytes, pattern: str, text: str = "text", keep: Sequence[str] = (), name: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``keep`` columns and the token ids of each whole text, without special tokens.

    Text is cut by ``pattern`` and each match encoded by itself.  A null or
    empty text has no ids, an empty table no rows.  Other columns are dropped;
    repeated rows are encoded alike.  With ``decoded``, that column has the
    bytes which the ids stand for, decoded where they were made.
    """
    content = df.sparkSession.sparkContext.broadcast(ranks)

    def start():
        ranks = parse_ranks(content.value)
        encoder, decoder = _Encoder(ranks, pattern), _Decoder(ranks)

        def convert(column: pa.Array) -> list[pa.Array]:
            packed = encoder.encode([t or "" for t in column.to_pylist()])
            offsets = np.fromiter(accumulate((len(p) // 4 for p in packed), initial=0), np.int32, len(packed) + 1)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            return [ids, decoder.decode(ids)] if decoded else [ids]

        return convert

    made = T.StructType().add(name, T.ArrayType(T.IntegerType(), True))
    return _with_columns(df, keep, text, made.add(decoded, T.BinaryType()) if decoded else made, start)


def decode(df: DataFrame, ranks: bytes, ids: str = "ids", keep: Sequence[str] = (), name: str = "decoded") -> DataFrame:
    """``keep`` columns and the bytes that the ids stand for; null and no ids give no bytes, an unknown id fails."""
    content = df.sparkSession.sparkContext.broadcast(ranks)

    def start():
        decoder = _Decoder(parse_ranks(content.value))
        return lambda column: [decoder.decode(column)]

    return _with_columns(df, keep, ids, T.StructType().add(name, T.BinaryType()), start)
