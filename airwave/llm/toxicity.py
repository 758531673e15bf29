"""Toxicity of whole texts by a small convolutional network, trained in numpy inside Spark tasks.

Words are hashed into buckets with learned embeddings. Filters of several widths slide over the
words; each keeps its largest response in the text, and a logistic layer on these maxima gives
the score. As filters and embeddings are linear, the response of a bucket at a place of a filter
is a table, and scoring is looking up and adding: no text is cut or padded.

A threshold for each language is chosen on texts kept out of training and moved to 0.5. What
language a text is in comes from its own words (a bag of hashed words per language, learned from
the same texts), since labels, lang, source and doc_id are no inputs of a score.

All learnable, labelled texts are learned from, as wholes. A hash of the id keeps one in CALIBRATION
out for the thresholds and deals all to parts of about PART_ROWS texts. In each of ROUNDS rounds every
part starts from the same network, goes through all its texts and hands on how the parameters moved;
the network moves by the mean over the parts that touched a parameter. Word counts and the logits
that thresholds are chosen on are Spark aggregates over all of these texts. The driver gets sums
alone: at most a row for each bucket, for each bucket and language, and for each language and step of
1 / LOGIT_STEPS of the logit. Sums are of whole numbers, so that their order does not matter.

Defined cases: null and empty texts and such without words get the score of a text without
evidence (all filters at rest); null labels or ids are not learned from; repeated rows are scored
each; with no labels of one class every score is 0; other columns are kept by ``scored``, whose
own are ``tox_score`` and ``tox_lang`` (columns of these names are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import give_back, learnable, saved, slices, text_bytes
from .words import words

BUCKETS = 1 << 17
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PART_ROWS = 4_096
ROUNDS = 5
#: Steps of a part in a round, at least: a part that has fewer goes through its texts again.
STEPS, BATCH = 240, 32
RATE = 0.01
CALIBRATION = 4
#: Words that a task holds at once to learn from, or one text.
CHUNK_WORDS = 1 << 22
#: Languages whose word counts a task holds at once.
COUNTED = 16
#: Parameters travel as whole multiples of 1 / MOVE_STEPS, logits of 1 / LOGIT_STEPS.
MOVE_STEPS = 1 << 32
LOGIT_STEPS, LOGIT_MOST = 1024, 64
#: What a word is made of here: ASCII letters and digits, and all of a non-ASCII character.
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, n + 1 offsets) of the texts."""
    hashes, _, _, first = words(data, offsets, APART)
    return (hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), first


@dataclass
class Network:
    embed: np.ndarray  # BUCKETS x DIMENSIONS
    filters: list[np.ndarray]  # for each width: width x DIMENSIONS x FILTERS
    bias: list[np.ndarray]
    weight: np.ndarray
    offset: float
    languages: list[str] = field(default_factory=list)
    profile: np.ndarray | None = None  # BUCKETS x languages: log probability of a bucket
    threshold: np.ndarray | None = None  # of each language, as a logit
    tables: list[list[np.ndarray]] = field(default_factory=list)

    def prepare(self) -> Network:
        """Response of each bucket at each place of each filter, for scoring."""
        self.tables = [[(self.embed @ f[j]).astype(np.float32) for j in range(len(f))] for f in self.filters]
        return self

    def dense(self) -> np.ndarray:
        """All parameters but the embeddings, in rows of DIMENSIONS."""
        flat = np.concatenate([*(f.ravel() for f in self.filters), *self.bias, self.weight, [self.offset]])
        return np.pad(flat, (0, -len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)

    def move(self, rows: np.ndarray, by: np.ndarray) -> None:
        """Add to rows of the parameters: the embeddings', then those of ``dense``."""
        embedded = rows < BUCKETS
        self.embed[rows[embedded]] += by[embedded]
        dense = self.dense()
        dense[rows[~embedded] - BUCKETS] += by[~embedded]
        flat, at = dense.ravel(), 0
        for array in [*self.filters, *self.bias, self.weight]:
            array[...] = flat[at : at + array.size].reshape(array.shape)
            at += array.size
        self.offset = float(flat[at])

    def logits(self, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        if not self.tables:
            self.prepare()
        out = np.full(n, self.offset)
        count = np.diff(first)
        for k, width in enumerate(WIDTHS):
            response = np.zeros((len(word) + 1, FILTERS), np.float32)
            whole = len(word) - width + 1
            if whole > 0:
                response[:whole] = self.tables[k][0][word[:whole]]
                for j in range(1, width):
                    response[:whole] += self.tables[k][j][word[j : whole + j]]
            text = np.repeat(np.arange(n), count)
            inside = np.arange(len(word)) <= first[1:][text] - width  # filters that lie in their text
            response[:-1][~inside] = -np.inf
            response[-1] = -np.inf
            some = count >= width
            best = np.zeros((n, FILTERS))
            if some.any():
                best[some] = np.maximum.reduceat(response, first[:-1][some], axis=0)
            out += np.maximum(best + self.bias[k], 0)[:, :] @ self.weight[k * FILTERS : (k + 1) * FILTERS] * 1.0
        return out

    def language(self, word: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Index of the language whose words the text's resemble; the last one if it has none."""
        n, k = len(first) - 1, len(self.languages)
        if not k:
            return np.full(n, 0)
        likely = np.vstack([self.profile[word], np.zeros((1, k), np.float32)])
        total = np.add.reduceat(likely, np.minimum(first[:-1], len(word)), axis=0)
        return np.where(np.diff(first) > 0, total.argmax(1), k)

    def score(self, word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        language = self.language(word, first)
        logit = self.logits(word, first) - self.threshold[language]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), language


def _new(seed: int = 3) -> Network:
    rng = np.random.RandomState(seed)
    return Network(
        rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)),
        [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)),
        0.0,
    )


class _Adam:
    """Adam for one array; rows that a step doesn't touch keep still."""

    def __init__(self, shape: tuple, rate: float = RATE):
        self.m, self.v, self.n, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        self.n += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * grad
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * grad**2
        m, v = self.m[rows] / (1 - 0.9**self.n), self.v[rows] / (1 - 0.99**self.n)
        value[rows] -= self.rate * m / (np.sqrt(v) + 1e-8)


def _batches(label: np.ndarray, rng: np.random.RandomState) -> Iterator[np.ndarray]:
    """Each text at least once, in batches of both classes; texts of the rarer class come again."""
    rare, common = sorted((rng.permutation(np.flatnonzero(label == c)) for c in (0, 1)), key=len)
    beside = np.resize(rare, len(common)) if len(rare) else rare
    for i in range(0, len(common), BATCH // 2):
        yield np.concatenate([common[i : i + BATCH // 2], beside[i : i + BATCH // 2]])


def _optimizers(net: Network) -> dict[str, _Adam]:
    opt = {"embed": _Adam(net.embed.shape), "weight": _Adam(net.weight.shape), "offset": _Adam((1,))}
    return opt | {f"f{k}": _Adam(f.shape) for k, f in enumerate(net.filters)} | {f"b{k}": _Adam(b.shape) for k, b in enumerate(net.bias)}


def _learn(net: Network, opt: dict[str, _Adam], docs: list[np.ndarray], label: np.ndarray, passes: int, rng: np.random.RandomState) -> None:
    """Go through the texts ``passes`` times."""
    offset = np.array([net.offset])
    for chosen in (b for _ in range(passes) for b in _batches(label, rng)):
        part = [docs[i] for i in chosen]
        first = np.concatenate([[0], np.cumsum([len(d) for d in part])])
        word, y = np.concatenate(part), label[chosen]
        unique, at = np.unique(word, return_inverse=True)
        x = net.embed[unique]
        n = len(part)
        hidden, where = np.zeros((n, FILTERS * len(WIDTHS))), []
        for k, width in enumerate(WIDTHS):
            table = [x @ net.filters[k][j] for j in range(width)]
            place = np.full((n, FILTERS), -1)
            for i in range(n):
                a, b = first[i], first[i + 1] - width + 1
                if b <= a:
                    continue
                r = table[0][at[a:b]]
                for j in range(1, width):
                    r = r + table[j][at[a + j : b + j]]
                top = r.argmax(0)
                place[i] = a + top
                hidden[i, k * FILTERS : (k + 1) * FILTERS] = r[top, np.arange(FILTERS)]
            where.append(place)
        active_in = hidden + np.concatenate(net.bias)
        active = np.maximum(active_in, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ net.weight + offset[0], -30, 30)))
        d = (p - y) / n
        grad_hidden = np.outer(d, net.weight) * (active_in > 0)
        opt["weight"].step(net.weight, active.T @ d + 1e-4 * net.weight)
        opt["offset"].step(offset, np.array([d.sum()]))
        grad_x = np.zeros_like(x)
        for k, width in enumerate(WIDTHS):
            g, place = grad_hidden[:, k * FILTERS : (k + 1) * FILTERS], where[k]
            i, f = np.nonzero((place >= 0) & (g != 0))
            grad_f = np.zeros_like(net.filters[k])
            for j in range(width):
                source = at[place[i, f] + j]
                np.add.at(grad_x, source, g[i, f][:, None] * net.filters[k][j][:, f].T)
                np.add.at(grad_f[j].T, f, g[i, f][:, None] * x[source])
            opt[f"f{k}"].step(net.filters[k], grad_f)
            opt[f"b{k}"].step(net.bias[k], g.sum(0))
        touched = np.flatnonzero(np.abs(grad_x).sum(1))
        if len(touched):
            opt["embed"].step(net.embed, grad_x[touched], unique[touched])
    net.offset = float(offset[0])


def _featured(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the buckets of a text's words, as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            word, first = buckets(*text_bytes(batch.column("text")))
            data = word.astype("<i4").tobytes()
            packed = [data[4 * a : 4 * b] for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(packed, pa.binary())], names=["doc_id", "lang", "words"])

    rows = docs.where(learnable() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang string, words binary")


def _words_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(w.as_buffer(), "<i4").astype(np.int64) for w in batch.column("words")]


def _moves(rows: DataFrame, net: Network, kept: bool, passes: int, round_: int) -> DataFrame:
    """For each part and row of the parameters that it touched, how far that moved, in whole steps."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def learned(number: int, chunks: Iterator[tuple[list[np.ndarray], np.ndarray]]) -> pa.RecordBatch:
        own = shared.value
        own = Network(own.embed.copy(), [f.copy() for f in own.filters], [b.copy() for b in own.bias], own.weight.copy(), own.offset)
        opt, rng = _optimizers(own), np.random.RandomState([round_, number])
        for docs, label in chunks:
            _learn(own, opt, docs, label, passes, rng)
        embedded = np.flatnonzero((own.embed != shared.value.embed).any(1))
        by = np.concatenate([(own.embed - shared.value.embed)[embedded], own.dense() - shared.value.dense()])
        slot = np.concatenate([embedded, BUCKETS + np.arange(len(own.dense()))]).astype(np.int32)
        steps = np.rint(by * MOVE_STEPS).astype(np.int64)
        return pa.RecordBatch.from_arrays([slot, *steps.T.copy()], names=["slot", *[f"d{j}" for j in range(DIMENSIONS)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((p, y, w) for b in batches for p, y, w in zip(b.column("part").to_pylist(), b.column("toxic").to_pylist(), _words_of(b), strict=True))
        for number, own in groupby(texts, itemgetter(0)):
            yield learned(number, _chunks(own))
        give_back()

    wanted = rows if kept else rows.where("not kept_out")
    return wanted.select("part", "toxic", "words").mapInArrow(run, "slot int, " + ", ".join(f"d{j} long" for j in range(DIMENSIONS)))


def _chunks(texts: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(texts, labels) of CHUNK_WORDS words, or of one longer text."""
    docs, label, size = [], [], 0
    for _, y, words_ in texts:
        if docs and size + len(words_) > CHUNK_WORDS:
            yield docs, np.array(label)
            docs, label, size = [], [], 0
        docs.append(words_)
        label.append(y)
        size += len(words_)
    if docs:
        yield docs, np.array(label)


def _trained(rows: DataFrame, kept: bool, passes: int) -> Network:
    net = _new()
    for round_ in range(ROUNDS):
        sums = [F.sum(f"d{j}").alias(f"d{j}") for j in range(DIMENSIONS)]
        moves = _moves(rows, net, kept, passes, round_).groupBy("slot").agg(F.count("*").alias("n"), *sums)
        found = moves.toArrow()  # at most one row for each bucket, and some sixty
        by = np.stack([found.column(f"d{j}").to_numpy() for j in range(DIMENSIONS)], 1) / MOVE_STEPS
        net.move(found.column("slot").to_numpy(), by / found.column("n").to_numpy()[:, None])
    return net


def _profiles(rows: DataFrame, net: Network) -> None:
    """Languages, and the probability of each bucket in them, from all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for language, count in counts.items():
                seen = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(seen), pa.string()), seen.astype(np.int32), count[seen]], names=["lang", "bucket", "n"])
            counts.clear()

        for batch in batches:
            for language, word in zip(batch.column("lang").to_pylist(), _words_of(batch), strict=True):
                if language not in counts and len(counts) == COUNTED:
                    yield from flushed()
                np.add.at(counts.setdefault(language, np.zeros(BUCKETS, np.int64)), word, 1)
        yield from flushed()
        give_back()

    known = rows.where(F.col("lang").isNotNull())
    net.languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    found = known.select("lang", "words").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not net.languages:
        return
    count = np.zeros((BUCKETS, len(net.languages)))
    column = np.searchsorted(np.array(net.languages, object), found.column("lang").to_numpy(zero_copy_only=False)) if len(found) else []
    count[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
    net.profile = np.log((count + 0.1) / (count.sum(0) + 0.1 * BUCKETS)).astype(np.float32)


def _best(step: np.ndarray, right: np.ndarray, wrong: np.ndarray) -> float:
    """The logit with the fewest errors, from numbers of toxic and other texts at each step of the logit."""
    unique, at = np.unique(step, return_inverse=True)
    z, toxic, other = unique / LOGIT_STEPS, np.bincount(at, right), np.bincount(at, wrong)
    # the cut lies below z[i]: errors are toxic texts under it and others over it
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(other[::-1])[::-1], [0]])
    edges = np.concatenate([[z[0] - 2], (z[1:] + z[:-1]) / 2, [z[-1] + 2]])
    return float(np.median(edges[errors == errors.min()]))


def _thresholds(rows: DataFrame, net: Network) -> None:
    """For each language the logit with the fewest errors, drawn toward that of all texts."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            docs = _words_of(batch)
            first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
            word = np.concatenate([np.zeros(0, np.int64), *docs])
            step = np.rint(np.clip(net.logits(word, first), -LOGIT_MOST, LOGIT_MOST) * LOGIT_STEPS)
            columns = [net.language(word, first).astype(np.int32), step.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], names=["language", "step", "toxic"])
        give_back()

    of = rows.select("toxic", "words").mapInArrow(run, "language int, step int, toxic int")
    toxic = F.sum("toxic").alias("right")
    found = of.groupBy("language", "step").agg(toxic, (F.count("*") - F.sum("toxic")).alias("wrong")).toArrow()
    language, step, right, wrong = (found.column(c).to_numpy() for c in ("language", "step", "right", "wrong"))
    overall = _best(step, right, wrong)
    out = [overall] * (len(net.languages) + 1)
    for j in range(len(net.languages)):
        use = language == j
        few = min(right[use].sum() + wrong[use].sum(), right[use].sum() * 4)
        if few >= 20:
            trust = few / (few + 20)
            out[j] = trust * _best(step[use], right[use], wrong[use]) + (1 - trust) * overall
    net.threshold = np.array(out)


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Fit on all learnable, labelled rows (see the module's docstring)."""
    known = labels.where(learnable() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    classes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return None
    parts = -(-sum(classes.values()) // PART_ROWS)
    of_id = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(n)).cast("int")
    # A plain sort-merge join at every size: neither side has a bound.
    rows = _featured(docs).join(known.hint("merge"), "doc_id").select(of_id("part", parts).alias("part"), "doc_id", "lang", "toxic", (of_id("kept", CALIBRATION) == 1).alias("kept_out"), "words")
    # A part is learned from by one task, in one order; every round reads these rows again.
    rows = saved(rows.repartitionById(parts, "part").sortWithinPartitions("part", F.xxhash64("doc_id"), "doc_id", "words").drop("doc_id"))
    counts = {(r["kept_out"], r["toxic"]): r["n"] for r in rows.groupBy("kept_out", "toxic").agg(F.count("*").alias("n")).collect()}
    if len({toxic for _, toxic in counts}) < 2:
        return None
    few = len(counts) < 4  # too few to keep any out
    common = max(counts.get((False, c), 0) + (counts.get((True, c), 0) if few else 0) for c in (0, 1))
    net = _trained(rows, few, max(1, -(-STEPS * (BATCH // 2) * parts // common)))
    _profiles(rows, net)
    net.embed = net.embed.astype(np.float32)
    _thresholds(rows if few else rows.where("kept_out"), net)
    return net


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents with tox_score (0 to 1; 0.5 is the threshold of the text's language) and tox_lang."""
    own = ["tox_score", "tox_lang"]
    rows = docs.drop(*own)
    if net is None:
        return rows.withColumns({"tox_score": F.lit(0.0), "tox_lang": F.lit(None).cast("string")})
    shared = docs.sparkSession.sparkContext.broadcast(net)  # bounded by BUCKETS and the languages
    schema = StructType([*rows.schema.fields, StructField("tox_score", DoubleType()), StructField("tox_lang", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        names = np.array([*net.languages, None], object)
        for batch in slices(batches):
            score, language = net.score(*buckets(*text_bytes(batch.column("text"))))
            columns = [pa.array(score), pa.array(names[language], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *own])

    return rows.mapInArrow(run, schema)
