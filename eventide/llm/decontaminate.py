"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and items are sequences of lower-cased words: runs of letters and digits,
and every letter of a script without spaces (Chinese, Japanese, Thai, Lao, Khmer,
Burmese) for itself. Letters are lower-cased in every script where that does not
change their length in UTF-8. A document leaks an item if some window of it can be turned into the
item by at most (1 - similarity) of the item's words in word edits. Windows as
long as the item begin at every word. The CGK random walk embeds a sequence so
that a small edit distance becomes a small Hamming distance; a repetition
samples SAMPLES coordinates of the embedding, windows that agree with an item
on them are candidates, and for every number of allowed edits as many
repetitions run as the target recall needs (measured on its items with that
many edits). An exact edit distance decides every candidate; items that would
need more than EXACT_AFTER repetitions are compared with every window left by
the tests below.

Ahead of the embedding stand two tests that lose nothing: k edits leave a run
of at least (n - k) / (k + 1) of an item's n words together, so some such run
of items must occur where the window lies; and a window within k edits has at
least n - k words that occur in items.

Items reach the tasks in blocks of about ITEM_ROWS rows or ITEM_BYTES bytes (one
pass over the documents each), so the benchmark may be of any size. Items of under MIN_WORDS
words are too short to tell and match nothing; items of over MAX_WORDS words
are searched as consecutive parts. Defined results: null or empty texts leak
nothing and null or empty items are no items; repeated documents repeat their
rows, repeated items do not; empty tables give an empty result; only ids and
texts are read, so columns of any other name may stand beside them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.llm.blocks import col, head_hashes, keyed_texts, small_batches, utf8, word_spans
from eventide.llm.toxicity_mil import IS_LETTER, LOWER
from eventide.session import shared_dir

SIMILARITY = 0.8
RECALL = 0.99
#: Coordinates a repetition samples.
SAMPLES = 2
MIN_WORDS, MAX_WORDS = 5, 256
#: Items that one pass over the documents looks for, about: rows and bytes of text.
ITEM_ROWS, ITEM_BYTES = 20_000, 16_000_000
#: Bits of the table that tells words of items.
TABLE_BITS = 20
#: Repetitions beyond which windows are compared with all items of their size.
EXACT_AFTER = 512
_PAD = np.uint64(0)


def allowed_edits(n_words: int, similarity: float) -> int:
    return int((1 - similarity) * n_words + 1e-9)


#: Code points of scripts that set no spaces, and of their punctuation (first, last).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3100, 0x312F), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xF900, 0xFAFF))
STOPS = ((0x3000, 0x303F), (0xFF01, 0xFF0F))


def _lower_table() -> np.ndarray:
    """The lower-case code point of each of two or three bytes, where it has as many."""
    table = np.arange(1 << 16, dtype=np.uint16)
    for cp in range(0x80, 1 << 16):
        low = chr(cp).lower()
        if len(low) == 1 and (ord(low) < 0x800) == (cp < 0x800) and 0x80 <= ord(low) < 1 << 16:
            table[cp] = ord(low)
    return table


_LOW = _lower_table()


def _wide(data: np.ndarray, first: int, last: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the whole characters of ``size`` (2 or 3) bytes, and their code points."""
    at = np.flatnonzero((data >= first) & (data <= last))
    at = at[at + size <= len(data)]
    for k in range(1, size):
        at = at[(data[at + k] & 0xC0) == 0x80]
    cp = data[at].astype(np.uint32) & (0xFF >> (size + 1))
    for k in range(1, size):
        cp = cp << 6 | (data[at + k] & 0x3F)
    return at, cp


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with every letter in lower case, at the same places."""
    low = LOWER[data]
    if (data >= 0xC3).any():
        for first, last, size in ((0xC3, 0xDF, 2), (0xE0, 0xEF, 3)):
            at, cp = _wide(data, first, last, size)
            new = _LOW[cp].astype(np.uint32)
            at, new = at[new != cp], new[new != cp]
            for k in range(1, size):
                low[at + k] = 0x80 | (new >> 6 * (size - 1 - k) & 0x3F)
            low[at] = (0xC0 if size == 2 else 0xE0) | new >> 6 * (size - 1)
    return low


def spans_of_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words in bytes."""
    if not (data >= 0xE0).any():
        return word_spans(data, IS_LETTER)
    inside, cut = IS_LETTER[data], np.zeros(len(data) + 1, bool)
    at, cp = _wide(data, 0xE0, 0xEF, 3)
    alone, stop = np.zeros(len(at), bool), np.zeros(len(at), bool)
    for mask, spans in ((alone, UNSPACED), (stop, STOPS)):
        for first, last in spans:
            mask |= (cp >= first) & (cp <= last)
    more = np.flatnonzero(data == 0xF0)  # the rarer Chinese characters have four bytes
    more = more[more + 4 <= len(data)]
    more = more[(data[more + 1] >= 0xA0) & (data[more + 1] <= 0xBF)]
    cut[at[alone]] = cut[at[alone] + 3] = cut[more] = cut[more + 4] = True
    for k in range(3):
        inside[at[stop] + k] = False
    before = np.concatenate(([False], inside))
    begin = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.concatenate((inside, [False]))
    end = np.flatnonzero(before & (~after | cut))
    return begin, end


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (of the first 16 bytes and the length), begin and end of the words in bytes."""
    begin, end = spans_of_words(data)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, end
    length = end - begin
    h = head_hashes(folded(data), begin, length, (16,))[0] + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) | np.uint64(1), begin, end  # never _PAD


def exact_words(text: bytes) -> list[bytes]:
    data = np.frombuffer(text, np.uint8)
    begin, end = spans_of_words(data)
    low = folded(data).tobytes()
    return [low[a:b] for a, b in zip(begin.tolist(), end.tolist())]


def edit_distance_to_prefix(item: list, text: list) -> tuple[int, int]:
    """The least number of word edits from ``item`` to a beginning of ``text``, and
    the length of the shortest such beginning."""
    row = list(range(len(text) + 1))
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    best = min(row)
    return best, row.index(best)


def _distances(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The same distance for rows of hashes, all items of one length."""
    width = windows.shape[1]
    steps = np.arange(width + 1)
    row = np.broadcast_to(steps, (len(items), width + 1)).astype(np.int32)
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (items[:, i:i + 1] != windows))
        row = (np.minimum.accumulate(new - steps, axis=1) + steps).astype(np.int32)
    return row.min(1)


class Embedding:
    """The random walks of all repetitions: what they depend on is the seed alone."""

    def __init__(self, repetitions: int, seed: int = 17):
        r = np.random.default_rng(seed)
        self.step = r.integers(0, 1 << 63, (repetitions, 2 * MAX_WORDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.where = r.random((repetitions, SAMPLES))
        self.mix = r.integers(0, 1 << 63, (repetitions, SAMPLES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def part(self, first: int, last: int) -> Embedding:
        """The repetitions from ``first`` to before ``last``."""
        out = object.__new__(Embedding)
        out.step, out.where, out.mix = (x[first:last].copy() for x in (self.step, self.where, self.mix))
        return out

    def signatures(self, words: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each window of ``n`` words, one number for the sampled coordinates of
        each repetition (columns)."""
        reps = np.arange(len(self.step))
        sampled = np.sort((self.where[None] * (2 * n)[:, None, None]).astype(np.int64), axis=2)
        at = np.zeros((len(start), len(reps)), np.int64)
        out = np.zeros(at.shape, np.uint64)
        for j in range(int(sampled.max(initial=-1)) + 1):
            inside = at < n[:, None]
            symbol = np.where(inside, words[np.minimum(start[:, None] + at, len(words) - 1)], _PAD)
            for k in range(SAMPLES):
                row, rep = np.nonzero(sampled[:, :, k] == j)
                if len(row):
                    mixed = (out[row, rep] ^ symbol[row, rep]) * self.mix[rep, k]
                    out[row, rep] = mixed ^ (mixed >> np.uint64(31))
            at += inside & ((symbol * self.step[reps, j] >> np.uint64(63)) == 1)
        return out


def _edited(item: np.ndarray, k: int, random: np.random.Generator) -> list:
    out = list(item)
    for _ in range(k):
        kind, at, fresh = random.integers(3), int(random.integers(len(out))), np.uint64(random.integers(1 << 62) * 2 + 1)
        if kind == 0:
            out[at] = fresh
        elif kind == 1:
            out.insert(at, fresh)
        else:
            out.pop(at)
    return out


def repetitions_for(items: list[np.ndarray], similarity: float, recall: float, embedding: Embedding,
                    pairs: int = 512, seed: int = 23) -> int | None:
    """The repetitions of ``embedding`` after which items (of one number of allowed
    edits) with that many random edits are candidates with probability ``recall``;
    none if it has too few. Measured on ``pairs`` copies of the shortest items, in
    which the edits lie closest; as they are a sample, half the misses are allowed."""
    items = sorted(items, key=len)[:pairs]
    if not (k := allowed_edits(len(items[0]), similarity)):
        return 1  # equal words have equal signatures
    random, old, new, size = np.random.default_rng(seed), [], [], []
    width = 2 * (len(items[-1]) + k)
    for c in range(pairs):
        item = items[c % len(items)]
        edited = _edited(item, k, random)
        behind = random.integers(1 << 62, size=width - len(edited), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        old.append([*item, *[_PAD] * (width - len(item))])
        new.append([*edited, *behind])
        size.append(len(item))
    old, new, size = np.array(old, np.uint64).ravel(), np.array(new, np.uint64).ravel(), np.array(size)
    missed, allowed = np.arange(pairs), int(pairs * (1 - recall) / 2)
    for first in range(0, len(embedding.step), 32):
        part = embedding.part(first, first + 32)
        agree = part.signatures(old, missed * width, size[missed]) == part.signatures(new, missed * width, size[missed])
        left = len(missed) - np.logical_or.accumulate(agree, axis=1).sum(0)
        if left[-1] <= allowed:
            return first + 1 + int(np.argmax(left <= allowed))
        missed = missed[~agree.any(1)]
    return None


class Targets:
    """A block of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, recall: float):
        self.similarity = similarity
        self.item, self.text_words, self.hashes = [], [], []
        for item_id, text in items:
            raw = text.encode()
            words, h = exact_words(raw), words_of(np.frombuffer(raw, np.uint8))[0]
            pieces = max(1, -(-len(words) // MAX_WORDS))
            cuts = np.linspace(0, len(words), pieces + 1).astype(int)
            for a, b in zip(cuts, cuts[1:]):
                if b - a >= MIN_WORDS:
                    self.item.append(item_id)
                    self.text_words.append(words[a:b])
                    self.hashes.append(h[a:b])
        self.longest = max(map(len, self.hashes), default=0)
        self.gap = allowed_edits(self.longest, similarity) + 1
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length: table of slots, sorted hashes
        self.of_size: dict[int, np.ndarray] = {}  # sorted hashes of the runs of the items of a size
        grams: dict[int, list[np.ndarray]] = defaultdict(list)
        for h in self.hashes:
            self.table[self._slot(h)] = True
            run = self._grams(h, self.run_length(len(h)))
            grams[self.run_length(len(h))].append(run)
            self.of_size[len(h)] = np.union1d(self.of_size.get(len(h), run), run)
        for q, all_ in grams.items():
            table = np.zeros(1 << TABLE_BITS, bool)
            sorted_ = np.unique(np.concatenate(all_))
            table[self._slot(sorted_)] = True
            self.runs[q] = table, np.append(sorted_, ~np.uint64(0))
        self.by_size: dict[int, list[int]] = defaultdict(list)
        by_edits: dict[int, list[np.ndarray]] = defaultdict(list)
        for k, h in enumerate(self.hashes):
            self.by_size[len(h)].append(k)
            by_edits[allowed_edits(len(h), similarity)].append(h)
        whole = Embedding(EXACT_AFTER)
        needed = {k: repetitions_for(members, similarity, recall, whole) for k, members in by_edits.items()}
        self.repetitions = {n: needed[allowed_edits(n, similarity)] for n in self.by_size}  # by size; none: exact
        self.embeddings = {r: whole.part(0, r) for r in set(needed.values()) if r}
        self.signed = {}
        for n, members in self.by_size.items():
            if not self.repetitions[n]:
                continue
            flat = np.concatenate([self.hashes[k] for k in members])
            signs = self.embeddings[self.repetitions[n]].signatures(flat, np.arange(len(members)) * n, np.full(len(members), n))
            for rep in range(self.repetitions[n]):
                order = np.argsort(signs[:, rep], kind="stable")
                self.signed[n, rep] = signs[order, rep], np.array(members)[order]

    def run_length(self, n: int) -> int:
        """Words of an item of ``n`` that any allowed edits leave together somewhere."""
        k = allowed_edits(n, self.similarity)
        return -(-(n - k) // (k + 1))

    @staticmethod
    def _grams(h: np.ndarray, q: int) -> np.ndarray:
        n, out = max(0, len(h) - q + 1), np.zeros(max(0, len(h) - q + 1), np.uint64)
        for j in range(min(q, 4)):  # of longer runs the first four words will do
            out = (out ^ h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _candidates(self, n: int, start: np.ndarray, signs: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(start, target)`` of the windows of ``n`` words to be compared: those that agree
        in some repetition, or all with all where there are no signatures."""
        if signs is None:
            members = np.array(self.by_size[n])
            step = max(1, 200_000 // len(members))
            for a in range(0, len(start), step):
                part = start[a:a + step]
                yield np.repeat(part, len(members)), np.tile(members, len(part))
            return
        pairs = []
        for rep, got in enumerate(signs.T):
            signed, of = self.signed[n, rep]
            low, high = np.searchsorted(signed, got, "left"), np.searchsorted(signed, got, "right")
            while len(hit := np.flatnonzero(low < high)):
                pairs.append(start[hit] * len(self.item) + of[low[hit]])
                low = low + 1
        if pairs:
            pair = np.unique(np.concatenate(pairs))
            yield pair // len(self.item), pair % len(self.item)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, target)`` of the windows within the allowed distance, by hash.
        ``words`` holds ``gap`` pads behind every text."""
        known = np.concatenate(([0], np.cumsum(self.table[self._slot(words)] & (words != _PAD), dtype=np.int32)))
        starts, targets = [], []
        hits = {}
        for q, (table, sorted_) in self.runs.items():
            got = self._grams(words, q)
            at = np.flatnonzero(table[self._slot(got)])
            at = at[sorted_[np.searchsorted(sorted_[:-1], got[at])] == got[at]]
            hits[q] = at, got[at]
        windows = {}
        for n in self.by_size:
            k, q = allowed_edits(n, self.similarity), self.run_length(n)
            at, got = hits[q]
            at = at[np.isin(got, self.of_size[n])]
            if len(words) < n or not len(at):
                continue
            near = np.unique((at[:, None] - np.arange(n + k - q + 1)).ravel())  # windows that reach over a hit
            near = near[(near >= 0) & (near <= len(words) - n)]
            start = near[known[near + n] - known[near] >= n - k]
            if len(start):
                windows[n] = start
        signs: dict[int, np.ndarray] = {}
        for r, embedding in self.embeddings.items():
            if not (sizes := [n for n in windows if self.repetitions[n] == r]):
                continue
            all_start = np.concatenate([windows[n] for n in sizes])
            all_n = np.repeat(sizes, [len(windows[n]) for n in sizes])
            step = max(1, (1 << 18) // r)
            signed = np.concatenate([embedding.signatures(words, all_start[a:a + step], all_n[a:a + step])
                                     for a in range(0, len(all_start), step)])
            signs |= {n: signed[all_n == n] for n in sizes}
        for n, start in windows.items():
            for at, target in self._candidates(n, start, signs.get(n)):
                k = allowed_edits(n, self.similarity)
                for a in range(0, len(at), 2_000):
                    s, t = at[a:a + 2_000], target[a:a + 2_000]
                    window = words[np.minimum(s[:, None] + np.arange(n + k), len(words) - 1)]
                    fine = _distances(np.array([self.hashes[x] for x in t]), window) <= k
                    starts.append(s[fine])
                    targets.append(t[fine])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(targets)


def overlapped(text: bytes, words: int, limit: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Parts of a text with their offsets; each begins ``words`` words ahead of the
    last one's end, so no window of so many words is cut."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(b" ", at, at + limit), text.rfind(b"\n", at, at + limit))
        cut = at + limit if cut <= at else cut
        yield at, text[at:cut]
        back = 16 * words
        while (begin := words_of(np.frombuffer(text[max(at, cut - back):cut], np.uint8))[1]).size <= words and cut - back > at:
            back *= 2
        ahead = max(at, cut - back) + int(begin[-words]) if len(begin) > words else cut
        at = ahead if ahead > at else cut
    yield at, text[at:]


def _scan(texts: list[bytes], targets: Targets, limit: int = 1 << 20) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """Of each text and item the best window: (distance, begin, end, words), in bytes."""
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}

    def settle(held: list[tuple[int, int, bytes]]) -> None:
        begins, ends, hashes, sizes, lows = [], [], [], [], {}
        for _, _, part in held:
            h, begin, end = words_of(np.frombuffer(part, np.uint8))
            hashes += [h, np.full(targets.gap, _PAD)]
            begins.append(begin)
            ends.append(end)
            sizes.append(len(h) + targets.gap)
        base = np.concatenate(([0], np.cumsum(sizes)))
        start, target = targets.find(np.concatenate(hashes))
        of = np.searchsorted(base, start, side="right") - 1
        for s, t, k in zip(start.tolist(), target.tolist(), of.tolist()):
            row, offset, part = held[k]
            w = s - int(base[k])
            if w >= len(begins[k]):
                continue
            item = targets.text_words[t]
            span = min(len(begins[k]), w + len(item) + allowed_edits(len(item), targets.similarity))
            if k not in lows:
                lows[k] = folded(np.frombuffer(part, np.uint8)).tobytes()
            text = [lows[k][a:b] for a, b in zip(begins[k][w:span].tolist(), ends[k][w:span].tolist())]
            distance, used = edit_distance_to_prefix(item, text)
            if distance <= allowed_edits(len(item), targets.similarity) and used:
                found = (distance, offset + int(begins[k][w]), offset + int(ends[k][w + used - 1]), len(item))
                key = row, targets.item[t]
                best[key] = min(best.get(key, found), found)

    held, size = [], 0
    for row, text in enumerate(texts):
        for offset, part in overlapped(text, targets.longest + targets.gap, limit):
            held.append((row, offset, part))
            size += len(part)
            if size >= limit:
                settle(held)
                held, size = [], 0
    if held:
        settle(held)
    return best


def _points(text: bytes) -> int:
    return len(text.decode("utf-8", "ignore"))


def _search(docs: DataFrame, targets: Targets) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b["text"])
            found = sorted(_scan(texts, targets).items())
            ids = b["doc_id"].take(pa.array([row for (row, _), _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([item for (_, item), _ in found], pa.int64()),
                pa.array([f[0] for _, f in found], pa.int64()), pa.array([f[3] for _, f in found], pa.int64()),
                pa.array([_points(texts[row][:f[1]]) for (row, _), f in found], pa.int64()),
                pa.array([_points(texts[row][:f[2]]) for (row, _), f in found], pa.int64())],
                names=["doc_id", "item_id", "distance", "item_words", "start", "end"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, item_id bigint, distance bigint, item_words bigint, start bigint, end bigint")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, distance, item_words, start, end)``: of every document
    and item that it leaks the closest window, the first of equals; start and end
    are code points, end exclusive."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    items = (benchmark.select(col(item_col).cast("bigint").alias("item_id"), col(item_text_col).cast("string").alias("text"))
             .filter("item_id is not null and text is not null").distinct())
    size = items.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    # a fifth to spare: hashed blocks differ in size
    blocks = max(1, -(-size["rows"] * 5 // (ITEM_ROWS * 4)), -(-(size["bytes"] or 0) * 5 // (ITEM_BYTES * 4)))
    texts, out = keyed_texts(docs, id_col, text_col), None
    for k in range(blocks):
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = sorted((r["item_id"], r["text"]) for r in block.collect())
        targets = Targets(rows, similarity, recall)
        if not targets.item:
            continue
        found = _search(texts, targets)
        out = found if out is None else out.union(found)
    if out is None:
        return texts.filter("false").selectExpr("doc_id", *[f"cast(null as bigint) {c}" for c in (
            "item_id", "distance", "item_words", "start", "end")])
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that leak no item, with their own columns. Rows are judged by a digest
    of their text, so rows without an id are searched like all others, and a clean
    text stays whoever shares its id."""
    spark = docs.sparkSession
    digest = F.md5(F.encode(F.coalesce(col(text_col).cast("string"), F.lit("")), "UTF-8"))
    found = leaks(docs.select(digest.alias("doc_id"), col(text_col).alias("text")), benchmark)
    # as a table: the join is planned on its real size, and moves no text where that is small
    path = shared_dir(spark, "leaks")
    found.select(F.col("doc_id").alias("_leaking")).distinct().write.parquet(path)
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("d"), digest.alias("_key"))
    return rows.join(spark.read.parquet(path), F.col("_key") == F.col("_leaking"), "left_anti").select("d.*")
