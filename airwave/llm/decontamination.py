"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and benchmark items are read as words (lower case, letters and digits). The random walk of
Chakraborty, Goldenberg and Koucky writes a word sequence at a pace set by random bits of its own
words, so that few edits become few Hamming differences. Walks drift apart with every edit, so an
item is cut into short anchor windows, as many as it takes for one of them to hold at most
WINDOW_EDITS of the allowed edits, wherever those lie. A repetition draws one walk and samples few
places of it; windows of a text whose samples equal an anchor window's are candidates. For each
window length, repetitions are added until windows with WINDOW_EDITS edits are met with a chance
of at least RECALL, measured for substituted, inserted and missing words at each place of the
window; an exact copy is met always. The words' edit distance between item and the best stretch of
text around a candidate then decides.

A window that can lie within WINDOW_EDITS of an anchor window must share word pairs with the items
(each edit breaks two); windows that share fewer aren't walked, which loses none.

The benchmark is read in blocks of BLOCK_ITEMS items; each block is one pass over the texts. No
row is shuffled: a text is searched as a whole where it is read, however often a passage occurs.

Defined cases: null and empty texts leak nothing; items of fewer than MIN_WORDS words, which would
occur in any text, take no part, null ones neither; repeated items are reported each, repeated
documents too; empty tables give no leaks; other columns are kept by ``marked`` and ``clean``,
whose own is ``leaks`` (a column of that name is replaced).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, slices, text_bytes
from .words import words

MIN_WORDS = 5
#: Allowed edits as a share of an item's words.
EDITS = 0.2
#: Edits that the best of an item's anchor windows can hold.
WINDOW_EDITS = 1
SAMPLES = 3
RECALL = 0.95
#: Random windows for each place of an edit, by which the chance of a hit is measured.
TRIALS = 300
MOST_REPEATS = 200
BLOCK_ITEMS = 20_000
PAD = np.uint64(0x5DEECE66D)

#: Word bytes: ASCII letters and digits, and all of a non-ASCII character.
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

LEAKS = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"


def _pairs(h: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one; the last word's has none."""
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.append(h[1:], PAD))


def _member(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)] == values


@dataclass
class Repeat:
    """One repetition for the anchor windows of one length."""

    pace: np.ndarray  # an odd number for each step of the walk
    sampled: np.ndarray  # the steps that are sampled, in order
    partial: list[np.ndarray]  # sorted signatures of the windows after each sampled step
    windows: np.ndarray  # windows in the order of the last ones


def walk(h: np.ndarray, start: np.ndarray, end: np.ndarray, r: Repeat, known: bool) -> tuple[np.ndarray, np.ndarray]:
    """(index of each start still in, its signature) after the walk from ``start`` before ``end``.

    With ``known``, starts whose samples so far are no item's are left behind at once.
    """
    index, at = np.arange(len(start)), start.copy()
    sign = np.zeros(len(start), np.uint64)
    seen = 0
    for step in range(r.sampled[-1] + 1):
        word = np.where(at < end, h[np.minimum(at, len(h) - 1)], PAD)
        if step == r.sampled[seen]:
            sign = mixed(sign + word + np.uint64(step))
            if known:
                keep = _member(r.partial[seen], sign)
                index, at, end, sign, word = index[keep], at[keep], end[keep], sign[keep], word[keep]
            seen += 1
            if not len(index):
                break
        at = at + ((word * r.pace[step]) >> np.uint64(63)).astype(np.int64)
    return index, sign


def _draw(rng: np.random.RandomState, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pace and sampled steps of a walk through ``size`` words."""
    steps = max(SAMPLES, int(1.5 * size))
    pace = rng.randint(0, 2**63 - 1, steps, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return pace, np.sort(rng.choice(steps, SAMPLES, replace=False))


def _trials(rng: np.random.RandomState, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, texts, kind of each): each text holds its window after WINDOW_EDITS edits of one
    kind, one of them at a place of the kind's own, after WINDOW_EDITS words and before others."""
    windows, texts, kinds = [], [], []
    word = lambda n: rng.randint(1, 2**63 - 1, n, dtype=np.int64).astype(np.uint64)
    for edit in ("other", "more", "less"):
        for place in range(size):
            for _ in range(TRIALS):
                own = word(size)
                text = own.tolist()
                also = rng.choice([x for x in range(size) if x != place], WINDOW_EDITS - 1, replace=False).tolist()
                for at in sorted([place, *also], reverse=True):
                    text[at : at + int(edit != "more")] = word(int(edit != "less")).tolist()
                text = [*word(WINDOW_EDITS).tolist(), *text, *word(size + WINDOW_EDITS).tolist()]
                windows.append(own)
                texts.append(np.array(text[: 2 * size + WINDOW_EDITS], np.uint64))
                kinds.append(f"{edit} {place}")
    return np.array(windows), np.array(texts), np.array(kinds)


@functools.cache
def walks(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """As many walks as it takes for windows of ``size`` words to be met after WINDOW_EDITS edits.

    The share of trials that is met has to reach RECALL by two standard errors for each kind and
    place of the edits; starts up to WINDOW_EDITS words from the right one are tried, as in a text.
    """
    rng = np.random.RandomState(11 + size)
    windows, texts, kinds = _trials(rng, size)
    n, width = texts.shape
    _, kind = np.unique(kinds, return_inverse=True)
    starts = np.arange(2 * WINDOW_EDITS + 1)
    start = (np.arange(n)[:, None] * width + starts).ravel()
    enough = np.zeros((n, len(starts)), bool)
    for k in starts:
        near = texts[:, k : k + size]
        pairs = [(windows[:, None, :-1] == near[:, :-1, None]) & (windows[:, None, 1:] == near[:, 1:, None])]
        enough[:, k] = pairs[0].any(2).sum(1) >= max(1, size - 1 - 2 * WINDOW_EDITS)
    own = np.arange(n) * size
    out: list[tuple[np.ndarray, np.ndarray]] = []
    met = np.zeros(n, bool)
    margin = 2 * np.sqrt(RECALL * (1 - RECALL) / TRIALS)
    while len(out) < MOST_REPEATS:
        pace, sampled = _draw(rng, size)
        out.append((pace, sampled))
        r = Repeat(pace, sampled, [], own)
        _, right = walk(windows.ravel(), own, own + size, r, False)
        _, sign = walk(texts.ravel(), start, start + size, r, False)
        met |= ((sign.reshape(n, -1) == right[:, None]) & enough).any(1)
        if (np.bincount(kind, met) / np.bincount(kind)).min() >= RECALL + margin:
            return out
    raise ValueError(f"windows of {size} words are not met with a chance of {RECALL}")


@dataclass
class Length:
    """Anchor windows of ``size`` words."""

    size: int
    repeats: list[Repeat]


class Block:
    """A block of items, ready to be searched for."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        h, _, _, first = words(*text_bytes(pa.array(texts, pa.string())), APART)
        self.ids = ids
        self.items = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        count = np.diff(first)
        use = np.flatnonzero(count >= MIN_WORDS)
        inner = np.zeros(len(h), bool)
        for i in use:
            inner[first[i] : first[i + 1] - 1] = True
        self.pairs = np.unique(_pairs(h)[inner])
        # of more windows than spare // (WINDOW_EDITS + 1), one holds WINDOW_EDITS edits at most
        parts = (EDITS * count[use]).astype(np.int64) // (WINDOW_EDITS + 1) + 1
        size = np.repeat(count[use] // parts, parts)
        self.item = np.repeat(use, parts)
        #: where each window begins in its item; those of an item lie side by side
        self.offset = (np.arange(len(size)) - np.repeat(np.cumsum(parts) - parts, parts)) * size
        begin = first[self.item] + self.offset
        self.lengths = []
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            self.lengths.append(Length(n, [self._repeat(pace, sampled, h, begin, own, n) for pace, sampled in walks(n)]))

    @staticmethod
    def _repeat(pace: np.ndarray, sampled: np.ndarray, h: np.ndarray, begin: np.ndarray, own: np.ndarray, size: int) -> Repeat:
        partial, sign = [], None
        for k in range(SAMPLES):
            r = Repeat(pace, sampled[: k + 1], [], own)
            _, sign = walk(h, begin[own], begin[own] + size, r, False)
            partial.append(np.unique(sign) if k < SAMPLES - 1 else np.sort(sign))
        return Repeat(pace, sampled, partial, own[np.argsort(sign, kind="stable")])

    def find(self, h: np.ndarray, first: np.ndarray) -> list[list[dict]]:
        """For each text the leaks: item_id, distance, first and last-plus-one word."""
        out: list[list[dict]] = [[] for _ in range(len(first) - 1)]
        if not len(h) or not self.lengths:
            return out
        hit = _member(self.pairs, _pairs(h))
        hit[first[1:][first[1:] > first[:-1]] - 1] = False  # no pair across texts
        shared = np.concatenate([[0], np.cumsum(hit)])
        if not shared[-1]:
            return out
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        stop = first[1:][text]
        met = [np.zeros((0, 3), np.int64)]  # text, item, where the item would begin
        for group in self.lengths:
            last = np.minimum(np.arange(len(h)) + group.size - 1, stop - 1)
            enough = shared[last] - shared[:-1] >= max(1, group.size - 1 - 2 * WINDOW_EDITS)
            start = np.flatnonzero(enough)
            if not len(start):
                continue
            end = np.minimum(start + group.size, stop[start])
            for r in group.repeats:
                index, sign = walk(h, start, end, r, True)
                if not len(index):
                    continue
                a = np.searchsorted(r.partial[-1], sign, "left")
                n = np.searchsorted(r.partial[-1], sign, "right") - a
                window = r.windows[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
                at = np.repeat(start[index], n)
                met.append(np.stack([text[at], self.item[window], at - self.offset[window]], 1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        reach: dict[tuple[int, int], int] = {}
        for t, i, s in np.unique(np.concatenate(met), axis=0).tolist():
            if s < reach.get((t, i), s):  # whatever begins near here was in a stretch just verified
                continue
            item = self.items[i]
            spare = int(EDITS * len(item))
            # holds whatever lies near the item and is met up to ``spare`` words from here: the item
            # begins at most ``near`` words from where a window says
            near = spare + WINDOW_EDITS
            low, high = max(int(first[t]), s - near), min(int(first[t + 1]), s + spare + near + len(item) + spare)
            reach[t, i] = s + spare + 1
            if np.isin(item, h[low:high]).sum() < len(item) - spare:  # each missing word is an edit
                continue
            d, a, b = verify(item, h[low:high])
            if d <= spare:
                if d == 0:  # what is met later begins later
                    reach[t, i] = int(first[t + 1])
                found = (d, int(low - first[t] + a), int(low - first[t] + b))
                best[t, i] = min(best.get((t, i), found), found)
        for (t, i), (d, a, b) in sorted(best.items()):
            out[t].append({"item_id": self.ids[i], "distance": d, "start": a, "end": b})
        return out


def _ends(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Edit distance of the item to the best stretch of the text that ends at each place."""
    step = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        next_row = np.empty_like(row)
        next_row[0] = i + 1
        next_row[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(next_row - step) + step
    return row


def verify(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, start, end) of the stretch of the text that is nearest to the item."""
    row = _ends(item, text)
    end = int(row.argmin())
    back = _ends(item[::-1], text[:end][::-1])
    return int(row[end]), end - int(np.flatnonzero(back == row[end])[0]), end


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark's items (item_id, text), BLOCK_ITEMS at a time."""
    ids, texts = [], []
    rows = benchmark.select(F.col("item_id").cast("long"), F.lower("text").alias("text"))
    for row in rows.toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        if len(ids) == BLOCK_ITEMS:
            yield Block(ids, texts)
            ids, texts = [], []
    if ids:
        yield Block(ids, texts)


def marked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with ``leaks``: for each item found its id, edit distance and words."""
    rows = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAKS))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # BLOCK_ITEMS items

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "_lower"):
                h, _, _, first = words(*text_bytes(batch.column("_lower")), APART)
                found = shared.value.find(h, first)
                if any(found):
                    before = batch.column("leaks").to_pylist()
                    found = pa.array([x + y for x, y in zip(before, found, strict=True)], kind)
                else:
                    found = batch.column("leaks")
                names = [n for n in batch.schema.names if n not in ("leaks", "_lower")]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], names=[*names, "leaks"])

        rows = rows.withColumn("_lower", F.lower("text")).mapInArrow(run, rows.schema)
    return rows


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, start, end: one row for each item that a document contains."""
    found = marked(docs.select(F.col("doc_id").cast("long"), "text"), benchmark)
    return found.select("doc_id", F.inline("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, as they are."""
    return marked(docs, benchmark).where(F.size("leaks") == 0).select(*docs.columns)
