"""Exact Jaccard join of documents on word n-grams, filtered under several global token orders.

A document's set holds the distinct shingles of four words of its whole text. Equal sets are one
node. If two sets are similar enough, their prefixes share a token under every order of all tokens.
The orders here put rare tokens first (by a count of all documents' tokens in hashed buckets, as
whole powers of two) and differ in how they order tokens that are alike in that.

The first order makes candidates: nodes that share a prefix token lie in one list. Its prefixes are
longer, by a third, so that similar sets share a fourth of them: nodes that share less go. A node is first
tried against one other, the hub of most of its lists. Linked nodes are one component, and lists in
which one component is left need no further look. In the other lists nodes of different components
are compared in blocks, by size and by parity bitmaps (as many bits as the set has tokens) whose differing
bits can't outnumber the differing tokens; a list with many nodes is cut into blocks that meet pair by pair. What passes must
share prefix tokens under all other orders as well, and is then confirmed on full sets. All filters
are necessary conditions, so no link between components is lost.

Defined cases: texts that are null, empty or without words have the empty set and are linked with
nothing; a text with fewer than four words has one shingle, its whole sequence; rows repeated with
one doc_id and one text are one document, each of its rows is returned; a row without doc_id links
others but is never a smallest id (component_id is null if no member has an id); empty tables give
no rows; very long texts are cut at blanks while their words are read; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, compact, key_bits, may_hold, mixed, saved, slices, text_bytes
from .near_dedup import connected
from .words import distinct, shingles, words

WIDTH = 4
#: In hundredths: linked with 100 * intersection >= SIMILARITY * union.
SIMILARITY = 85
ORDERS = 3
#: Bits of a parity bitmap, least and most.
BITMAP = (512, 1 << 15)
#: Buckets of the token counts: four a document, between these powers of two.
BUCKETS = (16, 22)
CHUNK = 4096
#: Nodes of a list that are compared at once; larger lists are cut into blocks of about so many.
BLOCK = 1024
#: Nodes that a task remembers, so as not to write the postings of equal sets again.
REMEMBERED = 1 << 20
#: Pairs whose ends (8 bytes each) are broadcast.
BROADCAST_PAIRS = 200_000
EDGES_PER_PART, PAIRS_PER_PART = 200_000, 20_000

_MULTIPLIER = 0x9E3779B97F4A7C15


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column("text"))
    hashes, _, _, first = words(data, offsets)
    return distinct(*shingles(hashes, first, WIDTH))


def _nodes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one."""
    count = np.diff(first)
    out = np.zeros(len(count), np.uint64)
    some = count > 0
    if some.any():
        out[some] = mixed(np.add.reduceat(mixed(values), first[:-1][some]) + mixed(count[some].astype(np.uint64)))
    return out


def _parities(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Of each set: for every bit, whether an odd number of its tokens falls on it. As many bits as
    the next power of two above its tokens, within BITMAP."""
    count = np.diff(first)
    bits = 1 << np.ceil(np.log2(np.clip(count, *BITMAP))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(bits)])
    row = np.repeat(np.arange(len(count)), count)
    place = (mixed(values ^ np.uint64(ORDERS)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(begin[row] + place, minlength=begin[-1]) & 1).astype(np.uint8))
    return [odd[i:j].tobytes() for i, j in zip(begin[:-1] // 8, begin[1:] // 8, strict=True)]


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Of two similar sets the first so many tokens share one, whatever the order."""
    return n - (SIMILARITY * n + 99) // 100 + 1


def least_shared(n: np.ndarray) -> np.ndarray:
    """Prefixes of the first order are longer by so many tokens, less one, and share that many."""
    return np.maximum(1, prefix_length(n) // 3)


def _prefixes(values: np.ndarray, first: np.ndarray, levels: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, set): the prefix of each set under an order."""
    level = levels[(values & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64)
    seed = np.uint64(((order + 1) * _MULTIPLIER) & 0xFFFFFFFFFFFFFFFF)
    key = level << np.uint64(58) | mixed(values ^ seed) >> np.uint64(6)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    sorted_ = np.lexsort((key, row))
    place = np.arange(len(values)) - first[:-1][row]
    length = prefix_length(count) + (least_shared(count) - 1 if order == 0 else 0)
    keep = place < length[row]
    return values[sorted_][keep], row[keep]


SIGNED = "doc_id long, text_hash long, n_shingles long, node long, bitmap binary, chunk int, counts binary"


def _packed(counts: np.ndarray) -> bytes:
    """Counts as planes of bytes, most of which are zero."""
    return zlib.compress(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def _sign(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each document; at the end the task's counts of tokens by bucket, in chunks."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
         ("bitmap", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())]
    )
    counts = np.zeros(1 << bits, np.int64)
    for batch in slices(batches):
        values, first = _sets(batch)
        counts += np.bincount((values & np.uint64(len(counts) - 1)).astype(np.int64), minlength=len(counts))
        node, size = _nodes(values, first), np.diff(first)
        bitmaps = _parities(values, first)
        nothing = pa.nulls(len(size), pa.int32()), pa.nulls(len(size), pa.binary())
        yield batch_of(schema, [batch.column("doc_id"), batch.column("text_hash"), size, pa.array(node.view(np.int64), mask=size == 0), bitmaps, *nothing])
    chunks = counts.reshape(-1, CHUNK)
    some = np.flatnonzero(chunks.any(1))
    none = [pa.nulls(len(some), f.type) for f in list(schema)[:5]]
    yield batch_of(schema, [*none, some.astype(np.int32), [_packed(chunks[i]) for i in some]])


def signed(docs: DataFrame) -> DataFrame:
    """Documents with their set's size, node and bitmap, and the tasks' token counts (``chunk`` is not null)."""
    bits = min(max(BUCKETS[0], int(docs.count()).bit_length() + 2), BUCKETS[1])
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(lambda batches: _sign(batches, bits), SIGNED)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            total[chunk] = total.get(chunk, 0) + _unpacked(counts)
    levels = [np.log2(c + 1).astype(np.uint8).tobytes() for c in total.values()]
    yield batch_of(pa.schema([("chunk", pa.int32()), ("levels", pa.binary())]), [list(total), levels])


def token_levels(rows: DataFrame) -> np.ndarray:
    """The power of two of each bucket's count above the usual one: at most 4 MB, whatever the rows."""
    sums = rows.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(_added, "chunk int, levels binary")
    found = {r["chunk"]: np.frombuffer(r["levels"], np.uint8) for r in sums.toLocalIterator()}
    if not found:
        return np.zeros(1 << BUCKETS[0], np.uint8)
    size = 1 << max(BUCKETS[0], int((max(found) + 1) * CHUNK - 1).bit_length())
    levels = np.zeros(size, np.uint8)
    for chunk, own in found.items():
        levels[chunk * CHUNK : (chunk + 1) * CHUNK] = own
    usual = int(np.median(levels[levels > 0]))
    return np.minimum(np.maximum(levels.astype(int) - usual, 0), 63).astype(np.uint8)


def postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, node): prefix tokens under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("token", pa.int64()), ("node", pa.int64())])
        seen: set[int] = set()
        for batch in slices(batches):
            values, first = _sets(batch)
            node = _nodes(values, first)
            tokens, row = _prefixes(values, first, levels, 0)
            new = np.array([n not in seen and not seen.add(n) for n in node.tolist()], bool)
            if len(seen) > REMEMBERED:
                seen.clear()
            keep = new[row]
            yield batch_of(schema, [tokens[keep].view(np.int64), node[row[keep]].view(np.int64)])

    return docs.select("text").mapInArrow(run, "token long, node long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, node): each once, of tokens with more than one node."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64())])
    last = np.zeros((0, 2), np.int64)  # the open token's last row
    written = True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([np.asarray(batch.column("token")), np.asarray(batch.column("node"))])
        rows = np.concatenate([last, rows])
        rows = rows[np.append(True, (rows[1:] != rows[:-1]).any(1))]
        same = rows[1:, 0] == rows[:-1, 0]
        several = np.append(same, False) | np.append(False, same)
        keep = several.copy()
        if len(last):
            keep[0] &= not written
        last, written = rows[-1:], bool(several[-1]) or (len(rows) == 1 and len(last) == 1 and written)
        yield batch_of(schema, [rows[keep, 0], rows[keep, 1]])


def lists(docs: DataFrame, nodes: DataFrame, levels: np.ndarray) -> DataFrame:
    """Lists of the nodes that share a prefix token, as rows (token, node).

    Nodes go that share fewer tokens than they must share with the smallest set that may be similar:
    a passage that many documents share doesn't make them candidates.
    """
    rows = postings(docs, levels).repartition("token").sortWithinPartitions("token", "node")
    rows = saved(rows.mapInArrow(_shared, "token long, node long"))
    smallest = F.ceil(F.col("n_shingles") * SIMILARITY / 100)
    length = smallest - F.ceil(smallest * SIMILARITY / 100) + 1
    least = F.greatest(F.lit(1), F.floor(length / 3))
    enough = rows.groupBy("node").agg(F.count("*").alias("k")).join(nodes, "node").where(F.col("k") >= least)
    return rows.join(enough.select("node"), "node", "left_semi").select("token", "node")


def _similar_size(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(x, y) >= SIMILARITY * np.maximum(x, y)


def _near(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether parity bitmaps (rows of 64-bit words) of sets with ``n`` tokens together may be similar.

    With intersection >= s * union at most (1 - s) / (1 + s) of all tokens differ, and each
    differing bit takes one of those.
    """
    apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return (100 + SIMILARITY) * apart <= (100 - SIMILARITY) * n


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps folded to ``width`` bytes, as rows of 64-bit words: halves joined by exclusive or are the
    bitmap of half the bits."""
    out = np.zeros((len(bitmaps), width // 8), np.uint64)
    for i, bitmap in enumerate(bitmaps):
        np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, width // 8), axis=0, out=out[i])
    return out


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        n, m = (np.asarray(batch.column(c)) for c in ("n", "m"))
        near = _similar_size(n, m)
        x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
        for i in np.flatnonzero(near).tolist():
            width = min(len(x[i]), len(y[i]))
            near[i] = _near(_folded([x[i]], width), _folded([y[i]], width), n[i : i + 1] + m[i : i + 1])[0]
        kept = batch.filter(pa.array(near))
        yield batch_of(schema, [kept.column("a"), kept.column("b")])


def hub_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): each node with the hub of most of its lists, if size and bitmap let them be similar; a
    list's hub is the node of which the largest share of tokens is in lists. ``members`` are saved."""
    share = members.groupBy("node").agg(F.count("*").alias("k")).join(nodes.select("node", "n_shingles"), "node")
    share = share.select("node", (F.col("k") / F.col("n_shingles")).alias("share"))
    hubs = members.join(share, "node").groupBy("token").agg(F.max_by("node", F.struct("share", "node")).alias("hub"))
    both = members.join(hubs, "token").where("node != hub").groupBy("node", "hub").agg(F.count("*").alias("k"))
    best = both.groupBy("node").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
    pairs = best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    for end, n, bits in (("a", "n", "x"), ("b", "m", "y")):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("n_shingles").alias(n), F.col("bitmap").alias(bits)), end)
    return pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(_near_pairs, "a long, b long")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, one, other): pairs of different components that may be similar."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("token", "one", "other", "own", "node", "label", "n_shingles")
    found: list[np.ndarray] = []
    count = 0

    def pairs(group: list[tuple]) -> None:
        nonlocal count
        number = np.concatenate([g[0] for g in group])
        bitmaps = [b for g in group for b in g[1]]
        width = np.array([len(b) for b in bitmaps])
        folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def rows_of(w: int) -> tuple[np.ndarray, np.ndarray]:
            """Bitmaps of w bytes of the rows that have so many or twice as many, and each row's place."""
            if w not in folded:
                some = np.flatnonzero((width == w) | (width == 2 * w))
                place = np.zeros(len(width), np.int64)
                place[some] = np.arange(len(some))
                folded[w] = _folded([bitmaps[i] for i in some], w), place
            return folded[w]

        own, node, label, n = (number[:, names.index(c)] for c in ("own", "node", "label", "n_shingles"))
        one, other = number[0, 1], number[0, 2]
        left, right = np.flatnonzero(own == one), np.flatnonzero(own == other)
        for at in range(0, len(left), 256):
            i = left[at : at + 256]
            may = (label[i][:, None] != label[right]) & _similar_size(n[i][:, None], n[right])
            if one == other:
                may &= node[i][:, None] < node[right]
            x, y = np.nonzero(may)
            x, y = i[x], right[y]
            for cut in range(0, len(x), 1 << 16):
                p, q = x[cut : cut + (1 << 16)], y[cut : cut + (1 << 16)]
                near = np.zeros(len(p), bool)
                least = np.minimum(width[p], width[q])
                for w in np.unique(least).tolist():
                    rows, place = rows_of(w)
                    own_width = least == w
                    u, v = p[own_width], q[own_width]
                    near[own_width] = _near(rows[place[u]], rows[place[v]], n[u] + n[v])
                if near.any():
                    ends = np.column_stack([node[p[near]], node[q[near]]])
                    found.append(np.unique(np.sort(ends, axis=1), axis=0))
                    count += len(found[-1])

    open_group: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        number = np.column_stack([np.asarray(batch.column(c)).astype(np.int64) for c in names])
        bitmap = batch.column("bitmap").to_pylist()
        begins = np.append(0, np.flatnonzero((number[1:, :3] != number[:-1, :3]).any(1)) + 1)
        for at, end in zip(begins.tolist(), [*begins[1:].tolist(), len(number)], strict=True):
            if open_group and (open_group[0][0][0, :3] != number[at, :3]).any():
                pairs(open_group)
                open_group = []
            open_group.append((number[at:end], bitmap[at:end]))
        if count > 1 << 16:
            both = np.unique(np.concatenate(found), axis=0)
            yield batch_of(schema, [both[:, 0], both[:, 1]])
            found.clear()
            count = 0
    if open_group:
        pairs(open_group)
    if found:
        both = np.unique(np.concatenate(found), axis=0)
        yield batch_of(schema, [both[:, 0], both[:, 1]])


def cross_pairs(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different components that share a list and may be similar."""
    own = labels.select("node", "label")
    marked = members.join(own, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marked = saved(marked)
    mixed_lists = marked.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("size"))
    mixed_lists = mixed_lists.where("least != most").select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = marked.join(mixed_lists, "token").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    rows = rows.select("token", "node", "label", "own", each)
    rows = rows.select("token", "node", "label", "own", F.least("own", "block").alias("one"), F.greatest("own", "block").alias("other"))
    rows = rows.join(nodes.select("node", "n_shingles", "bitmap"), "node")
    rows = rows.repartition("token", "one", "other").sortWithinPartitions("token", "one", "other")
    return rows.mapInArrow(_compared, "a long, b long").distinct()


def token_sets(docs: DataFrame, needed: DataFrame, levels: np.ndarray) -> DataFrame:
    """(node, tokens, prefixes) of the nodes in ``needed`` (node, doc_id, text_hash), from whole texts:
    the set's tokens, and its prefixes under the other orders as 32-bit hashes."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text_hash"))
    wanted = saved(needed.select("node", key.alias("needed")))
    bits = key_bits(wanted, "needed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("needed", pa.int64()), ("tokens", pa.binary()), ("prefixes", pa.binary())])
        for batch in batches:
            for part in slices([batch.filter(pa.array(may_hold(bits, np.asarray(batch.column("place")))))]):
                values, first = _sets(part)
                at = (first * 8).astype(np.int32)
                tokens = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(at), pa.py_buffer(values)])
                others = [_prefixes(values, first, levels, order) for order in range(1, ORDERS)]
                length = np.concatenate([[0], np.cumsum(prefix_length(np.diff(first)) * (np.diff(first) > 0))])
                short = [t.astype(np.uint32) for t, _ in others]
                prefixes = [b"".join(t[i:j].tobytes() for t in short) for i, j in zip(length, length[1:], strict=False)]
                yield batch_of(schema, [part.column("needed"), tokens, prefixes])

    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("needed"), "text")
    rows = rows.withColumn("place", F.pmod(F.xxhash64("needed"), F.lit(8 * len(bits))))
    sets = rows.mapInArrow(run, "needed long, tokens binary, prefixes binary")
    once = sets.groupBy("needed").agg(F.first("tokens").alias("tokens"), F.first("prefixes").alias("prefixes"))
    return once.join(wanted, "needed").select("node", "tokens", "prefixes")


def _under_all_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose prefixes share a token under each of the other orders."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint32).reshape(ORDERS - 1, -1) for v in (x, y))
            keep.append(all(len(np.intersect1d(x[k], y[k])) for k in range(ORDERS - 1)))
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield batch_of(schema, [kept.column("a"), kept.column("b")])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            both = np.concatenate([np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= SIMILARITY * (len(both) - common))
        kept = batch.filter(pa.array(linked, pa.bool_()))
        yield batch_of(schema, [kept.column("a"), kept.column("b")])


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, levels: np.ndarray) -> DataFrame:
    """The pairs (a, b), saved, that are similar: first by the prefixes under the other orders, then by
    their full sets."""

    def ends(pairs: DataFrame) -> DataFrame:
        """The pairs' nodes; broadcast where they are known to be few."""
        out = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        return F.broadcast(out) if pairs.count() <= BROADCAST_PAIRS else out

    needed = nodes.join(ends(pairs), "node", "left_semi").select("node", "doc_id", "text_hash")
    sets = saved(token_sets(docs, needed, levels))

    def with_both(pairs: DataFrame, column: str) -> DataFrame:
        own = sets.join(ends(pairs), "node", "left_semi")
        x, y = (own.select(F.col("node").alias(end), F.col(column).alias(name)) for end, name in (("a", "x"), ("b", "y")))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")

    left = saved(with_both(pairs, "prefixes").mapInArrow(_under_all_orders, "a long, b long"))
    return saved(with_both(left, "tokens").mapInArrow(_confirm, "a long, b long"))


def links(docs: DataFrame, nodes: DataFrame, levels: np.ndarray) -> DataFrame | None:
    """(node, label) of all nodes with links; None if there are none. ``nodes`` are saved."""
    members = saved(lists(docs, nodes.select("node", "n_shingles"), levels))
    if members.isEmpty():
        return None
    first = compact(saved(hub_pairs(members, nodes)), PAIRS_PER_PART)
    linked = confirmed(first, docs, nodes, levels)
    labels = compact(saved(connected(linked)), EDGES_PER_PART)
    rest = saved(cross_pairs(members, labels, nodes).join(first, ["a", "b"], "left_anti"))
    more = compact(rest, PAIRS_PER_PART)
    if more.isEmpty():
        return labels
    linked = linked.unionByName(confirmed(more, docs, nodes, levels))
    return connected(linked)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each row of ``docs``; ``component_id`` is the
    smallest doc_id that links reach, the document's own included."""
    rows = saved(signed(docs))
    levels = token_levels(rows)
    rows = rows.where("chunk is null").drop("chunk", "counts")
    # any of a set's documents may lend its text
    own = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("own")
    nodes = rows.where("node is not null").groupBy("node").agg(own, F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap"))
    nodes = saved(nodes.select("node", "own.doc_id", "own.text_hash", "n_shingles", "bitmap"))
    labels = links(docs, nodes, levels)
    named = nodes.select("node", "doc_id")
    if labels is None:
        named = named.withColumn("label", F.col("node"))
    else:
        named = named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
