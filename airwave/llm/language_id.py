"""Language of whole texts by interpolated Kneser-Ney character models.

Each language has a model of letters: the probability of a character after the ORDER - 1 before
it, with absolute discounting at every order and continuation counts below the highest. The
interpolation is worked out once: for every n-gram seen in any language the model stores its
final log probability in all languages, and for every context the log weight of backing off, in
arrays sorted by 64-bit n-gram hash. Scoring a text is a binary search for each character (and
for the few unseen ones a search at the next lower order) and a sum per text.

The language is the one with the lowest cross-entropy per character. Whether a text is in any of
the languages at all is decided against what texts of that language that were kept out of the
counts cost: a text is rejected if its cross-entropy lies far above them, given its length.

Only a bounded sample is learned from: at most SAMPLE_ROWS texts of a language, the smallest by
hash of the id, none longer than SAMPLE_CHARS characters. Scoring covers all texts as wholes.

Defined cases: a null text or one without letters is ``und`` with score 0, and is rejected; a text
without enough evidence falls to the language that is most frequent in the sample; a null lang is
not learned from; repeated rows are scored each; with nothing to learn from, all is ``und``;
other columns are kept by ``identified`` and ``accepted``, whose own are ``lang_pred``,
``lang_score`` and ``lang_rejected`` (columns of these names are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable, mixed, sample_ids, slices, text_bytes

ORDER = 4
PAD = ORDER
#: Bound of the sample: with 30 languages below 200 MB of text.
SAMPLE_ROWS = 300
SAMPLE_CHARS = 20_000
#: Of each language's sample, the share that is kept out of the counts, for calibration.
CALIBRATION = 0.25
DISCOUNT = 0.75
#: Rejected beyond so many times the worst calibration text's distance.
SLACK = 1.5
UNDEFINED = "und"


def _letters() -> np.ndarray:
    """For each code point the lower-case letter, or 0 if it is no letter."""
    points = [(i, chr(i)) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    out = np.zeros(0x110000, np.uint32)
    for i, c in points:
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


_table: list[np.ndarray] = []


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, n + 1 offsets into them) of the texts: letters in lower case, other runs as one 0.

    Every text begins with PAD zeros, so that no n-gram reaches into another text.
    """
    if not _table:
        _table.append(_letters())
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    starts = np.cumsum((data & 0xC0) != 0x80)  # characters up to each byte
    if len(data) and starts[-1] != len(points):  # not UTF-8 throughout: each text by itself
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    else:
        at = np.concatenate([[0], starts])[offsets]
    folded = _table[0][points]
    keep = folded != 0
    keep[1:] |= keep[:-1]  # one 0 after each word; | reads the values before the change
    begins = at[:-1][at[:-1] < at[1:]]
    keep[begins] = folded[begins] != 0
    kept = np.concatenate([[0], np.cumsum(keep)])[at]
    offsets = kept + PAD * np.arange(len(at))
    out = np.zeros(offsets[-1], np.uint32)
    place = np.repeat(PAD * np.arange(1, len(at)), np.diff(kept)) + np.arange(kept[-1])
    out[place] = folded[keep]
    return out, offsets


def ngrams(points: np.ndarray, where: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the ``order`` characters that end at each place of ``where``."""
    out = np.full(len(where), order, np.uint64)
    for k in range(order):
        out += points[where - k].astype(np.uint64) * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    return mixed(out)


@dataclass
class Model:
    """keys[k]: sorted hashes of the n-grams of k + 1 characters; logs[k]: their log2 probability in
    each language (a column each); backoff[k]: log2 weight of backing off, for contexts in
    contexts[k] of k characters."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    default: int = 0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: float = np.inf

    def costs(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits in each language, characters) of each text."""
        where, size = places(offsets)
        todo = np.arange(len(where))
        total = np.zeros((len(where) + 1, len(self.languages)), np.float32)  # one more for reduceat
        for k in range(ORDER - 1, -1, -1):
            g = ngrams(points, where[todo], k + 1)
            at = np.minimum(np.searchsorted(self.keys[k], g), len(self.keys[k]) - 1)
            hit = self.keys[k][at] == g
            if k == ORDER - 1:
                total[:-1] = np.where(hit[:, None], self.logs[k][at], np.float32(0))
            else:
                total[todo[hit]] += self.logs[k][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
            if k == 0:  # a letter never seen
                total[todo] += self.backoff[0][0]
                break
            c = ngrams(points, where[todo] - 1, k)
            at = np.minimum(np.searchsorted(self.contexts[k], c), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == c
            total[todo[known]] += self.backoff[k][at[known]]
        first = np.cumsum(size) - size
        bits = -np.add.reduceat(total, first, axis=0, dtype=np.float64)
        return np.where(size[:, None] > 0, bits, 0.0), size

    def predict(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index or -1, score 0 to 1, rejected) of each text."""
        bits, size = self.costs(points, offsets)
        letters = np.diff(np.concatenate([[0], np.cumsum(points != 0)])[offsets])
        order = bits.copy()
        order[:, self.default] -= 1e-6  # ties
        best = order.argmin(1)
        # the share of the best language if each character's evidence counts, at most 50 of them
        gain = -(bits - bits.min(1, keepdims=True)) * (np.minimum(size, 50) / np.maximum(size, 1))[:, None]
        score = 1 / np.exp2(np.maximum(gain, -60)).sum(1)
        rejected = (letters == 0) | (self.distance(bits, size, best) > self.limit)
        return np.where(letters > 0, best, -1), np.where(letters > 0, score, 0.0), rejected

    def distance(self, bits: np.ndarray, size: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far a text's bits per character lie above its language's, in units for its length."""
        if self.mean is None:
            return np.zeros(len(best))
        per = bits[np.arange(len(best)), best] / np.maximum(size, 1)
        unit = np.sqrt(self.spread[best] ** 2 + 6.0 / np.maximum(size, 1))
        return (per - self.mean[best]) / unit


def places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of all characters but the leading zeros, how many each text has)."""
    size = np.diff(offsets) - PAD
    return np.repeat(PAD * np.arange(1, len(offsets)), size) + np.arange(size.sum()), size


def fit(sample: pd.DataFrame) -> Model | None:
    """Count n-grams of (lang, text) rows and work out the interpolated models."""
    sample = sample.sort_values(["lang", "text"], ignore_index=True)
    languages = sorted(sample["lang"].unique())
    if not languages:
        return None
    rank = sample.groupby("lang").cumcount()
    kept_out = (rank % round(1 / CALIBRATION)) == 1
    train = sample[~kept_out]
    tables = []  # for each language and order: (n-gram, its context, its lower n-gram, count)
    for language in languages:
        points, offsets = _points(train.loc[train["lang"] == language, "text"])
        where, _ = places(offsets)
        own = []
        for k in range(ORDER):
            g = ngrams(points, where, k + 1)
            context = ngrams(points, where - 1, k)
            lower = ngrams(points, where, k) if k else np.zeros(len(where), np.uint64)
            unique, first, count = np.unique(g, return_index=True, return_counts=True)
            own.append((unique, context[first], lower[first], count.astype(float)))
        for k in range(ORDER - 1):  # below the highest order: in how many longer n-grams
            unique, context, lower, _ = own[k]
            longer = own[k + 1][2]
            own[k] = (unique, context, lower, np.bincount(np.searchsorted(unique, longer), minlength=len(unique)).astype(float))
        tables.append(own)
    letters = len(np.unique(np.concatenate([t[0][0] for t in tables]))) + 1
    keys, logs, contexts, backoff = [], [], [], []
    below = np.full((1, len(languages)), 1 / letters)  # every letter alike
    for k in range(ORDER):
        key = np.unique(np.concatenate([t[k][0] for t in tables]))
        context_of, lower_of = np.zeros(len(key), np.uint64), np.zeros(len(key), np.uint64)
        for t in tables:
            at = np.searchsorted(key, t[k][0])
            context_of[at], lower_of[at] = t[k][1], t[k][2]
        context = np.unique(context_of)
        where = np.searchsorted(context, context_of)
        p = np.zeros((len(key), len(languages)))
        weight = np.ones((len(context), len(languages)))
        lower = below[np.searchsorted(keys[k - 1], lower_of)] if k else np.repeat(below, len(key), 0)
        for j, t in enumerate(tables):
            unique, own_context, _, count = t[k]
            at = np.searchsorted(key, unique)
            seen = np.bincount(where[at], count, len(context))
            kinds = np.bincount(where[at], minlength=len(context))
            some = seen > 0
            weight[some, j] = DISCOUNT * kinds[some] / seen[some]
            p[at, j] = np.maximum(count - DISCOUNT, 0) / seen[where[at]]
        p += weight[where] * lower
        keys.append(key)
        logs.append(np.log2(p).astype(np.float32))
        contexts.append(context)
        backoff.append((np.log2(weight) + (np.log2(1 / letters) if k == 0 else 0)).astype(np.float32))
        below = p
    counts = sample.groupby("lang").size().reindex(languages).to_numpy()
    model = Model(languages, keys, logs, contexts, backoff, int(counts.argmax()))
    _calibrate(model, sample[kept_out])
    return model


def _points(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return characters(*text_bytes(pa.array(texts.tolist(), pa.string())))


def _calibrate(model: Model, kept_out: pd.DataFrame) -> None:
    """Mean and spread of bits per character of each language, and the largest distance met."""
    if kept_out.empty:
        return
    bits, size = model.costs(*_points(kept_out["text"]))
    own = np.searchsorted(model.languages, kept_out["lang"])
    use = size > 20
    per = bits[np.arange(len(own)), own] / np.maximum(size, 1)
    mean = np.array([np.median(per[use & (own == j)]) if (use & (own == j)).any() else np.nan for j in range(len(model.languages))])
    spread = np.array([per[use & (own == j)].std() if (use & (own == j)).sum() > 2 else np.nan for j in range(len(model.languages))])
    if np.isnan(mean).all():
        return
    model.mean = np.where(np.isnan(mean), np.nanmax(mean), mean)
    model.spread = np.maximum(np.where(np.isnan(spread), np.nanmax(np.append(spread, 0.3)), spread), 0.3)
    worst = model.distance(bits, size, bits.argmin(1)).max()
    model.limit = SLACK * max(worst, 4.0)


def train(docs: DataFrame) -> Model | None:
    """Fit on the bounded sample of learnable rows (see the module's docstring)."""
    rows = docs.where(learnable() & F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    chosen = sample_ids(rows.select(F.col("lang"), "doc_id"), ["lang"], SAMPLE_ROWS)
    sample = rows.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").select("lang", "text")
    return fit(sample.toPandas())


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with lang_pred, lang_score and lang_rejected."""
    own = ["lang_pred", "lang_score", "lang_rejected"]
    rows = docs.drop(*own)
    if model is None:
        return rows.withColumns({"lang_pred": F.lit(UNDEFINED), "lang_score": F.lit(0.0), "lang_rejected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    schema = rows.withColumns({"lang_pred": F.lit(""), "lang_score": F.lit(0.0), "lang_rejected": F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDEFINED], object)
        for batch in slices(batches, most=1 << 19):
            best, score, rejected = model.predict(*characters(*text_bytes(batch.column("text"))))
            columns = [pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *own])

    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose text is in one of the languages that the documents themselves teach."""
    return identified(docs, train(docs)).where("not lang_rejected").select(*docs.columns)
