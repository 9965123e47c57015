"""Byte-level BPE encoding and decoding by merge replay.

A block of the corpus is reduced to its distinct pre-tokens ("words"). An
inverted index from merge rank to the positions of the pairs that it merges is
built over all of them; merges are replayed in rank order, each on all its
positions at once, and only the touched neighbours are indexed anew. Texts are
then ids of their words, in order. Merges never cross a word, so replaying a
block at a time gives what replaying the corpus at once would, without moving
the words of every text through a shuffle.

Where a merge makes a pair of the same or a lower rank than itself (rank files
whose tokens can be joined in several ways), the words concerned are redone
one merge at a time; the ids are those of the tiktoken library.

Defined results: a null or empty text has no ids; repeated rows get equal ids;
an empty table gives an empty result. A text is cut for matching only where a
word must end, so very long texts are encoded whole in bounded memory.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eventide.llm.blocks import keyed_texts, small_batches, utf8

#: Rank of a pair that no merge joins.
NONE = np.int32(2**31 - 1)
#: A block ends at so many new distinct words or characters of text.
BLOCK_WORDS = 100_000
BLOCK_CHARS = 8_000_000
#: Words whose merges are replayed together, at most.
REPLAY_WORDS = 150_000
#: Distinct words a task remembers between blocks.
KEPT_WORDS = 200_000
#: Texts are matched in parts of about this many characters.
PART_CHARS = 1_000_000


class Vocabulary:
    """Token bytes by id, and the merges they imply."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        keys, made = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(1 << 62))
        self.made = np.append(np.array(made, np.int32)[order], NONE)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)

    @classmethod
    def parse(cls, rank_file: bytes) -> Vocabulary:
        pairs = (line.split() for line in rank_file.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], NONE)

    def merge_one(self, word: bytes) -> list[int]:
        """One merge at a time, the lowest rank first, the leftmost of equals."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[spread(self.start[ids], self.length[ids])].tobytes()


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one span behind the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else starts, lengths)
    return shift + np.arange(total)


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, lengths)``: the ids of all words in order, and how many each has."""
    whole = [vocab.ranks.get(w) for w in words]  # a word that is a token needs no merge
    open_ = [i for i, r in enumerate(whole) if r is None]
    length = np.array([len(words[i]) for i in open_], np.int64)
    data = np.frombuffer(b"".join(words[i] for i in open_), np.uint8)
    n = len(data)
    token = vocab.of_byte[data]
    word = np.repeat(np.arange(len(open_), dtype=np.int32), length)
    after = np.arange(1, n + 1, dtype=np.int32)
    after[np.cumsum(length) - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[np.cumsum(length) - length] = -1
    rank = np.full(n, NONE)
    inner = np.flatnonzero(after >= 0).astype(np.int32)
    rank[inner] = vocab.pair_ranks(token[inner], token[inner + 1])
    alive = np.ones(n, bool)
    redo = np.zeros(len(open_), bool)

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray, r: np.ndarray) -> None:
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        first = np.concatenate(([0], cuts)).tolist() if len(r) else []
        for key, a, b in zip(r[first].tolist(), first, [*first[1:], len(r)]):
            if key in index:
                index[key].append(at[a:b])
            else:
                index[key] = [at[a:b]]
                heapq.heappush(heap, key)

    inner = inner[rank[inner] != NONE]
    enter(inner, rank[inner])
    while heap:
        r = heapq.heappop(heap)
        at = index.pop(r)
        at = np.sort(np.concatenate(at) if len(at) > 1 else at[0])
        at = at[np.concatenate((at[1:] != at[:-1], [True])) & (rank[at] == r)]  # others were touched since
        if len(at) > 1:  # pairs that overlap merge from the left, every other one
            chained = at[1:] == after[at[:-1]]
            if chained.any():
                head = np.concatenate(([True], ~chained))
                place = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
                at = at[place % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        beyond = after[gone]
        token[at] = r
        after[at] = beyond
        rank[gone] = NONE
        rank[at] = NONE
        alive[gone] = False
        linked = beyond >= 0
        has, next_ = at[linked], beyond[linked]
        before[next_] = has
        front = before[at]
        front = front[front >= 0]
        touched = np.concatenate((has, front))
        new = vocab.pair_ranks(token[touched], token[after[touched]])
        rank[touched] = new
        if len(new) and new.min() <= r:
            redo[word[touched[new <= r]]] = True
        enter(touched[new != NONE], new[new != NONE])

    count = np.array([1] * len(words), np.int64)
    count[open_] = np.bincount(word[alive], minlength=len(open_))
    ids = np.empty(int(count.sum()), np.int64)
    start = np.concatenate(([0], np.cumsum(count)[:-1]))
    closed = np.array([i for i, r in enumerate(whole) if r is not None], np.int64)
    if len(closed):
        ids[start[closed]] = [r for r in whole if r is not None]
    if len(open_):
        ids[spread(start[open_], count[open_])] = token[alive]
    if redo.any():
        parts = np.split(ids, start[1:])
        for k in np.flatnonzero(redo):
            parts[open_[k]] = np.array(vocab.merge_one(words[open_[k]]), np.int64)
        count = np.array([len(p) for p in parts], np.int64)
        ids = np.concatenate(parts)
    return ids, count


_SPLIT = regex.compile(r"(?<=\S)\s")


def parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut before white space that follows something else: no word
    of the pattern goes on there, and none looks back over it."""
    at = 0
    while len(text) - at > limit:
        found = _SPLIT.search(text, at + limit)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:] if at else text


class _Numbers(dict):
    """Numbers words in the order of their first appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


#: Code points below this are matched by the faster of the two matchers.
NEAR = 0x250
_FAR = re.compile(f"[^\\x00-{chr(NEAR - 1)}]")


def near_pattern(pattern: str) -> str:
    r"""``pattern`` with \p{L}, \p{N}, \s and \S spelled out as the code points
    below NEAR that they match, in the syntax of the standard library."""
    inside, out, at = False, [], 0
    while at < len(pattern):
        found = re.compile(r"\\p\{\w+\}|\\[sS]|\\.|.", re.S).match(pattern, at)[0]
        at += len(found)
        if found in "[]":
            inside = found == "["
        if re.match(r"\\p|\\[sS]$", found):
            kind = regex.compile(found.lower() if found == r"\S" else found)
            members = "".join(re.escape(chr(c)) for c in range(NEAR) if kind.match(chr(c)))
            found = members if inside else f"[{'^' * (found == chr(92) + 'S')}{members}]"
        out.append(found)
    return "".join(out)


class Encoder:
    """Encodes texts block by block; remembers the ids of a bounded number of words."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.near, self.far = vocab, re.compile(near_pattern(pattern)).findall, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.number, self.known = _Numbers(), 0
        self.ids, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def numbers(self, text: str) -> np.ndarray:
        match = self.far if _FAR.search(text) else self.near
        found = [np.fromiter(map(self.number.__getitem__, match(p)), np.int32) for p in parts(text)]
        return found[0] if len(found) == 1 else np.concatenate(found)

    def settle(self) -> None:
        """Replay the merges on the words that are new."""
        words = [w.encode() for w in itertools.islice(self.number, self.known, None)]
        for at in range(0, len(words), REPLAY_WORDS):
            ids, count = replay(words[at:at + REPLAY_WORDS], self.vocab)
            self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
            self.count = np.concatenate((self.count, count))
        self.known = len(self.number)
        self.start = np.concatenate(([0], np.cumsum(self.count)[:-1])) if self.known else self.count

    def encode(self, numbers: np.ndarray) -> np.ndarray:
        return self.ids[spread(self.start[numbers], self.count[numbers])]

    def run(self, batches: Iterator[tuple[pa.Array, list[str]]]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
        """Of (keys, texts) batches, the ids of each text."""
        held, chars = [], 0
        for keys, texts in batches:
            held.append((keys, [self.numbers(t) for t in texts]))
            chars += sum(map(len, texts))
            if chars >= BLOCK_CHARS or len(self.number) - self.known >= BLOCK_WORDS:
                yield from self._emit(held)
                held, chars = [], 0
        yield from self._emit(held)

    def _emit(self, held: list) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
        self.settle()
        for keys, texts in held:
            yield keys, [self.encode(t) for t in texts]
        if self.known > KEPT_WORDS:
            self._forget()


_VOCABULARIES: dict[bytes, Vocabulary] = {}


def _vocabulary(rank_file: bytes) -> Vocabulary:
    if rank_file not in _VOCABULARIES:
        _VOCABULARIES[rank_file] = Vocabulary.parse(rank_file)
    return _VOCABULARIES[rank_file]


def read_ranks(path: str) -> bytes:
    """A rank file as it is, read once by the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every whole text; ids are little-endian
    unsigned 32-bit integers, one behind the other."""
    small_batches(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(rank_file), pattern)
        for keys, ids in encoder.run((b["doc_id"], b["text"].to_pylist()) for b in batches):
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(encoded: DataFrame, rank_file: bytes) -> DataFrame:
    """``encoded`` (as :func:`encode` returns it) plus the bytes that the ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(rank_file)
        for b in batches:
            texts = [vocab.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in utf8(b["ids"])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())],
                                             names=[*b.schema.names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def recode(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode(encode(...))`` gives, by one Python worker a task instead of two: the texts are
    encoded, and the bytes decoded from the ids as they are returned."""
    small_batches(docs.sparkSession)
    texts = keyed_texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(rank_file)
        encoder = Encoder(vocab, pattern)
        for keys, ids in encoder.run((b["doc_id"], b["text"].to_pylist()) for b in batches):
            raw = [x.astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([len(x) for x in ids], pa.int64()), pa.array(raw, pa.binary()),
                 pa.array([vocab.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in raw], pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary")
