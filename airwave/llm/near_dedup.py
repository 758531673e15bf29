"""Near-duplicate documents by a MinHash LSH forest.

A document's set holds the distinct shingles of five words of its whole text. Equal sets are one
node. A node's signature is written in several orders; each order is one tree of the forest, kept
not as a tree but as a sorted list: nodes with long common prefixes lie side by side. Candidates
are the next few neighbours in each order, so the depth at which two nodes meet adapts to the
region: where few nodes share a prefix a short one does, in crowded regions a longer one is
needed. The lists are range-partitioned by signature, so a crowded region spreads over tasks, and
the candidates are linear in the nodes whatever the size of a group. The last rows of a partition
meet the first ones of the next in a second small job, so partitions don't change the candidates.

Candidates whose signatures rule out the similarity are dropped; the others are confirmed on full
sets, best candidate of each node first: of the next neighbours alone, and then, between the
components that these have made, of the other neighbours. Nodes of a group that met only weaker members are then
tried against the best linked node (hub) of that group, and whatever is still open between two
components is confirmed as well. Components come from large-star and small-star steps.

Defined cases: texts that are null, empty or without words have the empty set, take no part and
keep their own id; a text with fewer than five words has one shingle, its whole sequence; rows
repeated with one doc_id and one text are one document; a row without doc_id links others but is
never a smallest id (component_id is null if no member has an id; ``kept`` is then true for all, but
``one_of_each`` keeps one of them); empty tables give no rows; other columns are ignored by
``components`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, compact, key_bits, may_hold, mixed, saved, slices, text_bytes
from .words import distinct, shingles, words

WIDTH = 5
#: In hundredths: linked with 100 * intersection >= 75 * union.
SIMILARITY = 75
TREES, LEVELS, VALUES = 24, 12, 96
NEIGHBOURS = 4
MIN_DEPTH = 2
#: 64 values of 4 bits go along with each row of the forest; two sets of the wanted similarity
#: agree in at least SKETCH_MATCHES of them but for one pair in 10,000.
SKETCH_MATCHES = 36
#: From here on a pair is likelier than not to be confirmed.
LIKELY_MATCHES = 48
#: Rows of a partition of the forest, as far as there are shuffle partitions for fewer.
ROWS_PER_PART = 5_000
#: Rows of a partition of saved edges, pairs and sets.
EDGES_PER_PART, PAIRS_PER_PART, SETS_PER_PART = 200_000, 20_000, 5_000

_rng = np.random.RandomState(7)
_A = _rng.randint(0, 2**63 - 1, VALUES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.randint(0, 2**63 - 1, VALUES, dtype=np.int64).astype(np.uint64)
#: Each order begins with values of its own and goes on with others.
_ORDERS = [
    np.concatenate([range(4 * t, 4 * t + 4), np.roll(_rng.permutation([v for v in range(VALUES) if v // 4 != t]), t)])[:LEVELS].astype(int)
    for t in range(TREES)
]


def _sets(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column(column))
    hashes, _, _, first = words(data, offsets)
    return distinct(*shingles(hashes, first, WIDTH))


def _binary(rows: np.ndarray) -> pa.Array:
    """A two-dimensional byte array as a binary column."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of fixed width as a two-dimensional byte array."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint8).reshape(-1, width)


SIGNED = "doc_id long, text_hash long, n_shingles long, node long, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("signature", pa.binary())]
    )
    for batch in slices(batches):
        values, first = _sets(batch)
        count = np.diff(first)
        some = count > 0
        node = np.zeros(len(count), np.uint64)
        signature = np.full((len(count), VALUES), 0xFFFFFFFF, np.uint32)
        if some.any():
            at = first[:-1][some]
            node[some] = mixed(np.add.reduceat(mixed(values), at) + mixed(count[some].astype(np.uint64)))
            for k in range(VALUES):
                signature[some, k] = np.minimum.reduceat(((values * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), at)
        yield batch_of(
            schema,
            [batch.column("doc_id"), batch.column("text_hash"), count,
             pa.array(node.view(np.int64), mask=~some), _binary(signature.view(np.uint8))],
        )


def signed(docs: DataFrame) -> DataFrame:
    """One row for each document: its set's size, its node (null for the empty set), its signature."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_sign, SIGNED)


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each node and tree: the tree and its first levels as one sortable key, and a sketch."""
    schema = pa.schema([("key", pa.binary()), ("node", pa.int64()), ("sketch", pa.binary()), ("label", pa.int64())])
    for batch in batches:
        for row in range(0, batch.num_rows, 4096):
            part = batch.slice(row, 4096)
            signature = np.ascontiguousarray(_bytes(part.column("signature"), 4 * VALUES)).view(np.uint32)
            low = (signature[:, :64] & 15).astype(np.uint8)
            sketch = low[:, 0::2] << 4 | low[:, 1::2]
            for tree, order in enumerate(_ORDERS):
                levels = (signature[:, order] & np.uint32(0xFFFF)).astype(">u2")  # low bits: high bits of minima are mostly 0
                key = np.hstack([np.full((len(levels), 1), tree, np.uint8), np.ascontiguousarray(levels).view(np.uint8)])
                yield batch_of(schema, [_binary(key), part.column("node"), _binary(sketch), part.column("label")])


def _agreeing(key: np.ndarray, node: np.ndarray, sketch: np.ndarray, label: np.ndarray, first: np.ndarray, step: int) -> tuple:
    """(a, b, agree) of the rows in ``first`` and those ``step`` further that share a prefix and agree,
    and are not known to be of one component."""
    same = key[first, : 1 + 2 * MIN_DEPTH] == key[first + step, : 1 + 2 * MIN_DEPTH]
    first = first[same.all(1) & (label[first] != label[first + step])]
    x = sketch[first] ^ sketch[first + step]
    agree = ((x & 0xF0) == 0).sum(1) + ((x & 0x0F) == 0).sum(1)
    good = agree >= SKETCH_MATCHES
    a, b = node[first[good]], node[first[good] + step]
    return np.minimum(a, b), np.maximum(a, b), agree[good].astype(np.int32)


PAIRS = "a long, b long, agree int"
#: Rows at the edges of partition ``part``: their place in it and how many rows it has.
EDGES = "part int, place long, size long, key binary, node long, sketch binary, label long"
#: A node that agrees with others within NEIGHBOURS places, and with how many values in sum.
NEAR = "near long, weight long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _forest_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (
        _bytes(batch.column("key"), 1 + 2 * LEVELS),
        np.asarray(batch.column("node")),
        _bytes(batch.column("sketch"), 32),
        np.asarray(batch.column("label")),
    )


def _weights(found: list[tuple]) -> list[np.ndarray]:
    """[nodes, sum of their agreements] of (a, b, agree)."""
    ends = np.concatenate([x for a, b, _ in found for x in (a, b)])
    agree = np.concatenate([x for _, _, agree in found for x in (agree, agree)])
    nodes, at = np.unique(ends, return_inverse=True)
    return [nodes, np.bincount(at, agree, len(nodes)).astype(np.int64)]


def _neighbours(batches: Iterator[pa.RecordBatch], steps: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a row and the ``steps`` next ones in its partition, how much nodes agree with the
    NEIGHBOURS next ones, and the partition's first and last rows."""
    from pyspark import TaskContext

    pairs, edges, near = _schema(PAIRS), _schema(EDGES), _schema(NEAR)
    schema = pa.schema([*pairs, *edges, *near])

    def out(part: pa.Schema, columns: list) -> pa.RecordBatch:
        own, n = dict(zip(part.names, columns, strict=True)), len(columns[0])
        return batch_of(schema, [own[f.name] if f.name in own else pa.nulls(n, f.type) for f in schema])

    head = kept = None
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _forest_rows(batch)
        size += batch.num_rows
        if head is None or len(head[0]) < NEIGHBOURS:
            more = rows if head is None else tuple(np.concatenate(x) for x in zip(head, rows, strict=True))
            head = tuple(x[:NEIGHBOURS].copy() for x in more)
        old = 0 if kept is None else len(kept[0])
        if kept is not None:  # the last rows of the batch before
            rows = tuple(np.concatenate(x) for x in zip(kept, rows, strict=True))
        agreed = []
        for step in range(1, NEIGHBOURS + 1):
            first = np.arange(max(0, old - step), len(rows[1]) - step)
            if len(first):
                found = _agreeing(*rows, first, step)
                if step <= steps:
                    yield out(pairs, list(found))
                agreed.append(found)
        if agreed:
            yield out(near, _weights(agreed))
        kept = tuple(x[-NEIGHBOURS:] for x in rows)
    if size:
        last = min(len(kept[1]), size - len(head[1]))  # what isn't among the first rows
        place = np.concatenate([np.arange(len(head[1])), np.arange(size - last, size)])
        key, node, sketch, label = (np.concatenate([x, y[len(y) - last :]]) for x, y in zip(head, kept, strict=True))
        part = np.full(len(place), TaskContext.get().partitionId(), np.int32)
        yield out(edges, [part, place, np.full(len(place), size), _binary(key), node, _binary(sketch), label])


def _across(batches: Iterator[pa.RecordBatch], steps: int) -> Iterator[pa.RecordBatch]:
    """As ``_neighbours``, of neighbours in different partitions, from all partitions' edges in order."""
    schema = pa.schema([*_schema(PAIRS), *_schema(NEAR)])
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    part, place, size = (np.concatenate([np.asarray(b.column(c)) for b in batches]) for c in ("part", "place", "size"))
    rows = tuple(np.concatenate(x) for x in zip(*[_forest_rows(b) for b in batches], strict=True))
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    before = np.cumsum(size[begins]) - size[begins]  # rows of the partitions before
    at = np.repeat(before, np.diff(np.append(begins, len(part)))) + place
    for step in range(1, NEIGHBOURS + 1):
        first = np.arange(max(0, len(part) - step))
        first = first[(part[first] != part[first + step]) & (at[first + step] - at[first] == step)]
        if len(first):
            a, b, agree = _agreeing(*rows, first, step)
            if step <= steps:
                yield batch_of(schema, [a, b, agree, *[pa.nulls(len(a), pa.int64())] * 2])
            near, weight = _weights([(a, b, agree)])
            yield batch_of(schema, [*(pa.nulls(len(near), f.type) for f in list(schema)[:3]), near, weight])


def candidates(nodes: DataFrame, steps: int = NEIGHBOURS) -> tuple[DataFrame, DataFrame]:
    """(distinct pairs (a, b, agree), a < b, of rows at most ``steps`` apart in any of the forest's
    orders; (node, weight): how much each node agrees with those within NEIGHBOURS).

    Pairs of one ``label`` are left out. Neighbours at the edges of partitions meet in a second job, of
    2 * NEIGHBOURS rows a partition at most, so pairs don't depend on the partitions. ``nodes`` are saved.
    """
    forest = nodes.select("node", "signature", "label").mapInArrow(_orders, "key binary, node long, sketch binary, label long")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(parts, -(-TREES * nodes.count() // ROWS_PER_PART)))
    forest = forest.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")
    found = saved(forest.mapInArrow(lambda batches: _neighbours(batches, steps), f"{PAIRS}, {EDGES}, {NEAR}"))
    edges = found.where("part is not null").select("part", "place", "size", "key", "node", "sketch", "label")
    across = edges.coalesce(1).sortWithinPartitions("part", "place").mapInArrow(lambda batches: _across(batches, steps), f"{PAIRS}, {NEAR}")
    found = found.where("part is null").select("a", "b", "agree", "near", "weight").unionByName(saved(across))
    pairs = found.where("a is not null").groupBy("a", "b").agg(F.max("agree").alias("agree"))
    return pairs, found.where("near is not null").groupBy(F.col("near").alias("node")).agg(F.sum("weight").alias("weight"))


def shingle_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``needed`` (node, doc_id, text_hash), from whole texts.

    A bit filter lets through few other texts, so that sets of needed texts alone are shuffled.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text_hash"))
    wanted = saved(needed.select("node", key.alias("needed")))
    bits = key_bits(wanted, "needed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("needed", pa.int64()), ("shingles", pa.binary())])
        for batch in batches:
            for part in slices([batch.filter(pa.array(may_hold(bits, np.asarray(batch.column("place")))))]):
                values, first = _sets(part)
                at = (first * 8).astype(np.int32)
                sets = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(at), pa.py_buffer(values)])
                yield batch_of(schema, [part.column("needed"), sets])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").select(key.alias("needed"), "text")
    rows = rows.withColumn("place", F.pmod(F.xxhash64("needed"), F.lit(8 * len(bits))))
    sets = rows.mapInArrow(run, "needed long, shingles binary")
    return sets.join(wanted, "needed").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= SIMILARITY * (len(both) - common))
        yield batch_of(schema, [batch.column("a"), batch.column("b"), linked])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``linked``: the similarity of their full sets reaches the bound."""
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_confirm, "a long, b long, linked boolean")


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component of edges (a, b), for nodes with edges.

    Large-star and small-star steps in turn until nothing moves; each is a grouped minimum and a
    join on the same key, so a node with very many edges is pre-aggregated and its join split.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Edges (v, m) with m < v."""
        if large:
            both = narrow(edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m"))))
        else:
            both = edges
        least = both.groupBy("v").agg(F.min("m").alias("least")).withColumn("least", F.least("least", "v"))
        joined = both.join(least, "v")
        if large:
            out = joined.where("m > v").select(F.col("m").alias("v"), F.col("least").alias("m"))
        else:
            out = joined.select(F.col("m").alias("v"), F.col("least").alias("m")).unionByName(
                least.select("v", F.col("least").alias("m"))
            )
        return narrow(narrow(out.where("m < v")).distinct())

    edges = saved(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("m < v"))
    parts = max(1, -(-edges.count() // EDGES_PER_PART))
    few = parts < int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def narrow(rows: DataFrame) -> DataFrame:
        """Few edges in few partitions, so that shuffles have few files (or none are needed)."""
        return rows.coalesce(parts) if few else rows

    edges, before = narrow(edges).distinct(), None
    while True:
        edges = narrow(saved(star(star(edges, True), False)))
        # distinct edges that are the same as before are stars
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    spread = edges.select(F.col("v").alias("node"), F.col("m").alias("label"))
    return spread.unionByName(edges.select(F.col("m").alias("node"), F.col("m").alias("label")).distinct())


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs between different components, with both labels (a node without links is its own)."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    return pairs.where("label_a != label_b")


def _best(pairs: DataFrame) -> DataFrame:
    """The pair of each node with the best agreement, ties to the smaller nodes."""
    ends = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("end"))
    best = ends.groupBy("end").agg(F.max_by(F.struct("a", "b"), F.struct("agree", -F.col("a"), -F.col("b"))).alias("p"))
    return best.select("p.a", "p.b").distinct()


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _hubs(labels: DataFrame, central: DataFrame) -> DataFrame:
    """(label, hub): the most central node of each component, ties to the smallest."""
    hub = F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub")
    return labels.join(central, "node").groupBy("label").agg(hub)


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """(node, label) of all nodes with links; None if no two nodes are near. ``nodes`` are saved.

    The next neighbour in each order comes first. Once its links have made components, the other
    neighbours are sought among the nodes that have any, and only between components.
    """
    alone = nodes.withColumn("label", F.col("node"))
    pairs, central = candidates(alone, 1)
    central = compact(saved(central), EDGES_PER_PART)
    if central.isEmpty():
        return None
    pairs = compact(saved(pairs), PAIRS_PER_PART)
    nodes = saved(nodes.join(central, "node", "left_semi"))
    sets = saved(shingle_sets(docs, nodes.select("node", "doc_id", "text_hash")))
    sets = compact(sets, SETS_PER_PART)

    # first the best candidate of each node, and the hub of the group it is likely to be in
    likely = pairs.where(F.col("agree") >= LIKELY_MATCHES)
    first = _best(pairs)
    if not likely.isEmpty():
        groups = compact(saved(connected(likely)), EDGES_PER_PART)
        to_hub = groups.join(_hubs(groups, central), "label").where("node != hub").select(*_pair("node", "hub"))
        first = first.unionByName(to_hub).distinct()
    tried = compact(saved(confirmed(first, sets)), PAIRS_PER_PART)
    linked = tried.where("linked").select("a", "b")
    labels = compact(saved(connected(linked)), EDGES_PER_PART)

    own = nodes.select("node", "signature").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs = compact(saved(candidates(saved(own))[0]), PAIRS_PER_PART)

    # a node whose best open candidate is a weaker member of another component, against its hub,
    # while that finds links: at most two pairs for each open node
    while True:
        open_pairs = compact(saved(_labelled(pairs.join(tried, ["a", "b"], "left_anti"), labels)), PAIRS_PER_PART)
        if open_pairs.isEmpty():
            return labels
        best = open_pairs.join(_best(open_pairs), ["a", "b"])
        hubs = _hubs(labels, central)
        to_hub = [
            best.join(hubs.withColumnRenamed("label", f"label_{y}"), f"label_{y}").select(*_pair(x, "hub"))
            for x, y in (("a", "b"), ("b", "a"))
        ]
        new = to_hub[0].unionByName(to_hub[1]).where("a != b").distinct().join(tried, ["a", "b"], "left_anti")
        found = compact(saved(confirmed(new, sets)), PAIRS_PER_PART)
        tried = tried.unionByName(found)
        if found.where("linked").isEmpty():
            break
        linked = linked.unionByName(found.where("linked").select("a", "b"))
        labels = compact(saved(connected(linked)), EDGES_PER_PART)

    rest = open_pairs.select("a", "b").join(tried, ["a", "b"], "left_anti")
    last = saved(confirmed(rest, sets)).where("linked").select("a", "b")
    return labels if last.isEmpty() else connected(linked.unionByName(last))


def _first() -> Column:
    """The first document of a group: the one that stays."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signed rows, nodes with their first document and the label of their component), both saved."""
    rows = saved(signed(docs))
    nodes = rows.where("node is not null").groupBy("node").agg(_first().alias("own"), F.first("signature").alias("signature"))
    nodes = saved(nodes.select("node", "own.doc_id", "own.text_hash", "signature"))
    labels = links(docs, nodes)
    named = nodes.drop("signature")
    if labels is None:
        return rows, named.withColumn("label", F.col("node"))
    return rows, named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def components(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: one row for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, the document's own included.
    """
    rows, named = _grouped(docs)
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, repeated: bool = True) -> DataFrame:
    """The first document of each group by (doc_id, nulls last, and hash of the text), as it is.

    Documents are rows with one doc_id and one text; rows without doc_id are documents of their own,
    and one of those with the same text stays. With ``repeated`` all rows of a document that stays
    are kept, without it one, the first by a hash of its columns.
    """
    rows, named = _grouped(docs)
    first = named.groupBy("label").agg(_first().alias("first"))
    named = named.join(first, "label").select("node", "first")
    keys = rows.groupBy("doc_id", "text_hash").agg(F.first("node").alias("node"), F.count("*").alias("n"))
    keys = keys.join(named, "node", "left")
    stays = F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))
    # empty sets without an id take no part: nothing says that they are one document
    one = F.col("node").isNotNull() & F.col("doc_id").isNull() if repeated else F.col("node").isNotNull() | F.col("doc_id").isNotNull()
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), stays.alias("_stays"), ((F.col("n") > 1) & one).alias("_one"))
    marks = saved(keys.where("not _stays or _one"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    out = docs.join(marks, same, "left_anti")
    several = marks.where("_stays")
    if several.isEmpty():
        return out
    # rows of one key are cut to one in each task before they are shuffled
    row = F.struct(*[F.col(c) for c in docs.columns])
    single = docs.join(several, same).groupBy("_id", "_hash").agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("_row"))
    return out.unionByName(single.select("_row.*"))
