"""Repair of conversations whose turns are blank, repeated, cut short or out of order.

A repaired conversation is empty or has the role initials ``s?(ua)+``. Rows are kept (0), given the
role user or assistant (3) or deleted (4, a must for blank and repeated rows); empty user and
assistant rows are inserted (3); a truncated row that isn't deleted costs 3 more. The cheapest edits
are found; among equally cheap ones those whose initials (K, R, D, I) come first in ASCII.

All that an edit depends on is a row's symbol: its role initial and whether it is truncated or must
go, nine symbols. Rows of a conversation are cut into pieces of symbols. Pairs of symbols that
follow each other most often become rules (Re-Pair), many unlike pairs in each round, learned from
the pieces of all conversations. What a row does to the four states of the grammar of roles (nothing
yet, after system, after user, after assistant) is a 4 x 4 matrix over (minimum, plus); a rule's is
the product of its two symbols' matrices, computed once, bottom-up. Its entries' audits are ropes: an
entry names the entries of both symbols that it joins. Insertions come before a row only, so audits
of one entry never begin one another, and the first of them stays first whatever follows.

Pieces are rewritten with the rules and folded, in parallel, long conversations in many pieces; the
pieces' matrices are then joined in order, streamed.

Defined cases: nulls in role and text, and in the damage key, are one space; null turns come first;
rows of one turn are taken by role, then by the SHA-256 of the text, equal rows together; a role's
initial is its first character, an empty role has none. conv_id null is a conversation. Very long
conversations are streamed; only their audit, one byte a row, is held whole. Empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of a piece, rules made in a round, rounds: a rule stands for at most 2**ROUNDS rows.
PIECE, RULES, ROUNDS = 4096, 96, 10

#: Symbols: role initial s, u, a or other, plain or truncated; the last must go.
SYMBOLS = [(role, cut) for cut in (False, True) for role in "sua "] + [(" ", None)]
MUST_GO = len(SYMBOLS) - 1
#: States: nothing yet, after system, after user, after assistant. Whole conversations end in 0 or 3.
STATES = 4
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: What an inserted or reroled row is in each state, and the state after it.
NEXT_ROLE = ["user", "user", "assistant", "user"]
_NEXT = [2, 2, 3, 2]


@functools.cache
def _insertions() -> list[list[int | None]]:
    """How many insertions lead from one state to another, at least; None if none do."""
    out: list[list[int | None]] = []
    for state in range(STATES):
        row: list[int | None] = [None] * STATES
        n = 0
        while row[state] is None:
            row[state] = n
            state, n = _NEXT[state], n + 1
        out.append(row)
    return out


class Rope:
    """A string as a tree of parts, with its length and a hash, so that equal parts are skipped."""

    __slots__ = ("text", "left", "right", "length", "hash")
    BASE, PRIME = 911_382_323, (1 << 61) - 1

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.length, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * self.BASE + ord(c)) % self.PRIME
        else:
            self.length = left.length + right.length
            self.hash = (left.hash * pow(self.BASE, right.length, self.PRIME) + right.hash) % self.PRIME

    def parts(self) -> Iterator[str]:
        stack = [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                yield rope.text
            else:
                stack += [rope.right, rope.left]

    def __str__(self) -> str:
        return "".join(self.parts())

    def __lt__(self, other: Rope) -> bool:
        ours, theirs = [self], [other]
        while ours and theirs:
            x, y = ours.pop(), theirs.pop()
            if x is y or (x.length == y.length and x.hash == y.hash):
                continue
            if x.left is not None and (x.length >= y.length or y.left is None):
                ours += [x.right, x.left]
                theirs.append(y)
            elif y.left is not None:
                theirs += [y.right, y.left]
                ours.append(x)
            else:
                n = min(x.length, y.length)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                ours += [Rope(x.text[n:])] * (x.length > n)
                theirs += [Rope(y.text[n:])] * (y.length > n)
        return bool(theirs)


#: (cost, audit) for each pair of states, or None.
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _better(x: Entry, y: Entry) -> Entry:
    if x is None or y is None:
        return y if x is None else x
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if y[1] < x[1] else x


def _product(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product; ropes are joined for the cheapest ways alone."""
    out: Matrix = []
    for row in x:
        new: list[Entry] = []
        for j in range(len(y[0])):
            ways = [(a[0] + b[0], k) for k, a in enumerate(row) if a and (b := y[k][j])]
            least = min((cost for cost, _ in ways), default=None)
            best: Entry = None
            for cost, k in ways:
                if cost == least:
                    best = _better(best, (cost, Rope(left=row[k][1], right=y[k][j][1])))
            new.append(best)
        out.append(new)
    return out


@functools.cache
def _edits(symbol: int) -> tuple:
    """The matrix of one row: insertions before it, then its edit."""
    role, cut = SYMBOLS[symbol]
    more = TRUNCATED if cut else 0
    out: Matrix = [[None] * STATES for _ in range(STATES)]

    def offer(i: int, j: int, cost: int, letter: str, n: int) -> None:
        out[i][j] = _better(out[i][j], (cost + n * INSERT, Rope("I" * n + letter)))

    for i, row in enumerate(_insertions()):
        for k, n in enumerate(row):
            if n is None:
                continue
            offer(i, k, DELETE, "D", n)
            if symbol != MUST_GO:
                if k in _AFTER.get(role, {}):
                    offer(i, _AFTER[role][k], KEEP + more, "K", n)
                offer(i, _NEXT[k], REROLE + more, "R", n)
    return tuple(tuple(row) for row in out)


# --- the grammar ------------------------------------------------------------------------------


def _pairs(text: np.ndarray, symbols: int) -> np.ndarray:
    """Codes of adjacent pairs, -1 where one is a border; of a run of one symbol each second pair."""
    left, right = text[:-1].astype(np.int64), text[1:].astype(np.int64)
    code = np.where((left < 0) | (right < 0), -1, left * symbols + right)
    same = (left == right) & (left >= 0)
    begins = same & ~np.append(False, same[:-1])
    at = np.arange(len(same))
    since = at - np.maximum.accumulate(np.where(begins, at, 0))
    code[same & (since % 2 == 1)] = -1
    return code


@dataclass
class Grammar:
    """Rules by round: symbols len(SYMBOLS) + i stand for rules[i], a pair of symbols."""

    rules: list[tuple[int, int]] = field(default_factory=list)
    #: Rules before each round, and after the last.
    rounds: list[int] = field(default_factory=lambda: [0])

    def rewritten(self, text: np.ndarray) -> np.ndarray:
        """Sequences, each ended by -1, with all rules applied in order."""
        symbols = len(SYMBOLS) + len(self.rules)
        text = text.astype(np.int32)
        for first, last in zip(self.rounds, self.rounds[1:], strict=False):
            if len(text) < 2:
                break
            codes = np.array([a * symbols + b for a, b in self.rules[first:last]], np.int64)
            order = np.argsort(codes)
            code = _pairs(text, symbols)
            place = np.minimum(np.searchsorted(codes[order], code), len(codes) - 1)
            hit = np.flatnonzero(codes[order][place] == code)
            text[hit] = len(SYMBOLS) + first + order[place[hit]]
            text = np.delete(text, hit + 1)
        return text

    def add(self, counts: list[tuple[int, int]]) -> bool:
        """A round of the most frequent pairs (code, count), none overlapping another; False if there are none."""
        symbols = len(SYMBOLS) + len(self.rules)
        lefts: set[int] = set()
        rights: set[int] = set()
        first = len(self.rules)
        for code, n in counts:
            a, b = divmod(code, symbols)
            apart = not (lefts | rights) & {a} if a == b else a not in rights and b not in lefts
            if n >= 2 and apart and len(self.rules) - first < RULES:
                self.rules.append((a, b))
                lefts.add(a)
                rights.add(b)
        if len(self.rules) > first:
            self.rounds.append(len(self.rules))
        return len(self.rules) > first

    def matrices(self) -> list[Matrix]:
        """One for each symbol."""
        return _matrices(tuple(self.rules))


@functools.lru_cache(2)
def _matrices(rules: tuple[tuple[int, int], ...]) -> list[Matrix]:
    """Of the symbols and the rules, bottom-up, once in each worker."""
    out = [_edits(s) for s in range(len(SYMBOLS))]
    for a, b in rules:
        out.append(_product(out[a], out[b]))
    return out


def _texts(column: pa.Array) -> np.ndarray:
    """Pieces as one array, each ended by -1."""
    parts = column.to_pylist()
    out = np.frombuffer(b"".join(p + b"\xff" for p in parts), np.uint8).astype(np.int32)
    out[out == 255] = -1
    return out


def _few(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` pieces."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def learn(pieces: DataFrame) -> Grammar:
    """Rules from the ``symbols`` of all pieces; rounds of counting, in which only the counts of pairs
    of symbols meet, until no pair is there twice."""
    texts = saved(pieces.groupBy("symbols").agg(F.count("*").alias("n")))
    grammar = Grammar()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])
        symbols = len(SYMBOLS) + len(grammar.rules)
        total: dict[int, int] = {}
        for batch in _few(batches):
            text = grammar.rewritten(_texts(batch.column("symbols")))
            if len(text) < 2:
                continue
            weight = np.asarray(batch.column("n"))
            piece = np.cumsum(text < 0) - (text < 0)
            code = _pairs(text, symbols)
            real = code >= 0
            own, at = np.unique(code[real], return_inverse=True)
            for c, n in zip(own.tolist(), np.bincount(at, weight[piece[:-1][real]]).tolist(), strict=True):
                total[c] = total.get(c, 0) + int(n)
        yield batch_of(schema, [list(total), list(total.values())])

    for _ in range(ROUNDS):
        counts = texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        top = [(r["code"], r["n"]) for r in counts.orderBy(F.desc("n"), "code").limit(4 * RULES).collect()]
        if not grammar.add(top):
            break
    return grammar


# --- rows and pieces --------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``times``: rows by the damage that crc32(conv_id:turn) % 20 names."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
        kind.alias("kind"),
    )
    return out.where("kind != 0").drop("kind")


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


_KEY = ["conv_id", "turn", "role", "digest"]


def faulty(rows: DataFrame) -> DataFrame:
    """Distinct rows (with ``times``) and their faults: blank, cut short, and whether the first is a repetition.

    Equal rows are counted before they are shuffled; a text that occurs in several turns is found by
    the least turn of (conversation, role, text), joined back.
    """
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    distinct = saved(rows.groupBy(*_KEY).agg(F.first("text").alias("text"), F.sum("times").alias("times")))
    turn = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    least = distinct.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("least"), F.count("*").alias("n")).where("n > 1")
    least = least.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "least")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    later = F.col("least").isNotNull() & ~F.col("turn").eqNullSafe(F.col("least.turn"))
    return distinct.join(least, same, "left").select(
        *_KEY, "text", "times",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        later.alias("again"),
    )


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


PIECES = "conv_id long, part int, number int, symbols binary, first string, last string, blank long, duplicate long, truncated long, illegal long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


_ALLOWED = {"su", "ua", "au"}


class _Piece:
    def __init__(self, conv_id: int | None, number: int):
        self.conv_id, self.number = conv_id, number
        self.symbols: list[bytes] = []
        self.size, self.first, self.last = 0, None, None
        self.counts = [0, 0, 0, 0]

    def add(self, initial: str, symbol: int, fault: int | None, times: int) -> None:
        if self.first is None:
            self.first, adjacent = initial, times - 1
        else:
            adjacent = times - 1
            self.counts[3] += self.last + initial not in _ALLOWED
        self.counts[3] += adjacent  # no role may follow itself
        if fault is not None:
            self.counts[fault] += times
        self.symbols.append(bytes([symbol]) * times)
        self.size += times
        self.last = initial


def _cut_pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows into pieces of at most ``most`` symbols with their counts."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    done: list[_Piece] = []
    open_piece: _Piece | None = None

    def written() -> pa.RecordBatch:
        columns = [[p.conv_id for p in done], [part] * len(done), [p.number for p in done], [b"".join(p.symbols) for p in done],
                   [p.first for p in done], [p.last for p in done], *([p.counts[k] for p in done] for k in range(4))]
        return batch_of(_schema(PIECES), columns)

    for batch in batches:
        for conv_id, initial, times, blank, cut, again in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "initial", "times", "blank", "cut", "again")), strict=True):
            if open_piece is None or open_piece.conv_id != conv_id:
                if open_piece is not None:
                    done.append(open_piece)
                open_piece = _Piece(conv_id, 0)
            # the first of equal rows, then those that repeat it
            runs = [(times, 0, MUST_GO)] if blank else []
            if not blank:
                plain = "sua".find(initial) if initial and initial in "sua" else 3
                if not again:
                    runs.append((1, 2, plain + 4) if cut else (1, None, plain))
                runs.append((times - (not again), 1, MUST_GO))
            for n, fault, symbol in runs:
                while n:
                    if open_piece.size == most:
                        done.append(open_piece)
                        open_piece = _Piece(conv_id, open_piece.number + 1)
                    now = min(n, most - open_piece.size)
                    open_piece.add(initial, symbol, fault, now)
                    n -= now
            if len(done) >= 1024:
                yield written()
                done = []
    if open_piece is not None:
        done.append(open_piece)
    yield written()


def cut_pieces(rows: DataFrame, most: int = PIECE) -> DataFrame:
    """Pieces (conv_id, part, number) in order: rows are range-partitioned, so a conversation with
    very many rows lies in several parts."""
    narrow = rows.select(*_KEY, _initial(F.col("role")).alias("initial"), "times", "blank", "cut", "again")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = narrow.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    return narrow.mapInArrow(lambda batches: _cut_pieces(batches, most), PIECES)


# --- solving ----------------------------------------------------------------------------------


def fold(grammar: Grammar, symbols: np.ndarray, begin: tuple[int, ...]) -> Matrix:
    """The rows of the matrix of rewritten symbols for the states in ``begin``."""
    out: Matrix = [[(0, Rope()) if j == i else None for j in range(STATES)] for i in begin]
    matrices = grammar.matrices()
    for s in symbols.tolist():
        out = _product(out, matrices[s])
    return out


def _finished(row: list[Entry]) -> tuple[int, str]:
    """The cheapest way to a whole conversation: insertions at the end, then the states 0 and 3."""
    best: Entry = None
    for k, entry in enumerate(row):
        for end in (0, 3):
            n = _insertions()[k][end]
            if entry and n is not None:
                best = _better(best, (entry[0] + n * INSERT, Rope(left=entry[1], right=Rope("I" * n))))
    return best[0], str(best[1])


SOLVED = "conv_id long, part int, number int, begin int, end int, cost long, audit string"


def solved(pieces: DataFrame, grammar: Grammar) -> DataFrame:
    """Entries of each piece's matrix, from all states it may begin in: state 0 alone for ``alone``
    pieces, whose one row is the whole conversation (``end`` is null), else all four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[bytes, bool], list] = {}
        for batch in _few(batches):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "number", "symbols", "alone")), strict=True))
            missing = [k for k in dict.fromkeys((r[3], r[4]) for r in rows) if k not in known]
            if missing:
                text = grammar.rewritten(_texts(pa.array([k[0] for k in missing], pa.binary())))
                for k, own in zip(missing, np.split(text, np.flatnonzero(text < 0) + 1), strict=False):
                    matrix = fold(grammar, own[:-1], (0,) if k[1] else tuple(range(STATES)))
                    if k[1]:
                        known[k] = [(0, None, *_finished(matrix[0]))]
                    else:
                        known[k] = [(i, j, e[0], str(e[1])) for i, row in enumerate(matrix) for j, e in enumerate(row) if e]
            out = [(*r[:3], *entry) for r in rows for entry in known[r[3], r[4]]]
            for at in range(0, len(out), 4096):
                yield batch_of(_schema(SOLVED), [list(c) for c in zip(*out[at : at + 4096], strict=True)])
            if sum(len(k[0]) for k in known) > 1 << 22:
                known.clear()

    return pieces.select("conv_id", "part", "number", "symbols", "alone").mapInArrow(run, SOLVED)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of long conversations, in order: (conv_id, cost, audit)."""
    schema = _schema("conv_id long, cost long, audit string")
    open_id, row, piece, matrix = None, None, None, None

    def closed() -> Iterator[pa.RecordBatch]:
        if row is not None:
            cost, audit = _finished(_product([row], matrix)[0])
            yield batch_of(schema, [[open_id], [cost], [audit]])

    for batch in batches:
        for conv_id, part, number, i, j, cost, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "number", "begin", "end", "cost", "audit")), strict=True):
            if row is None or conv_id != open_id:
                yield from closed()
                open_id, row, piece = conv_id, [(0, Rope()), None, None, None], (part, number)
                matrix = [[None] * STATES for _ in range(STATES)]
            elif (part, number) != piece:
                row, piece = _product([row], matrix)[0], (part, number)
                matrix = [[None] * STATES for _ in range(STATES)]
            matrix[i][j] = (cost, Rope(audit))
    yield from closed()


def audits(pieces: DataFrame, grammar: Grammar) -> DataFrame:
    """conv_id, cost and audit of every conversation that has rows. ``pieces`` are saved."""
    several = pieces.groupBy("conv_id").agg(F.count("*").alias("several")).where("several > 1").withColumnRenamed("conv_id", "_conv")
    marked = pieces.join(several, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    entries = saved(solved(marked.withColumn("alone", F.col("several").isNull()), grammar))
    short = entries.where("end is null").select("conv_id", "cost", "audit")
    parts = entries.where("end is not null").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "number")
    return short.unionByName(parts.mapInArrow(_joined, "conv_id long, cost long, audit string"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each conversation led by its audit: the SHA-256 of the repaired rows."""
    schema = _schema("conv_id long, cost long, audit string, repaired_sha256 string")
    done: list[tuple] = []
    now = None

    class Open:
        def __init__(self, conv_id, cost, audit):
            self.conv_id, self.cost, self.audit = conv_id, cost, audit
            self.at, self.state, self.any, self.hash = 0, 0, False, hashlib.sha256()

        def write(self, role: str, text: str) -> None:
            self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

        def insert(self) -> None:
            while self.audit[self.at : self.at + 1] == "I":
                self.write(NEXT_ROLE[self.state], "")
                self.state = _NEXT[self.state]
                self.at += 1

        def row(self, role: str, text: str, times: int) -> None:
            while times:
                self.insert()
                end = min(self.at + times, len(self.audit))
                run = end - self.at if self.audit.count("D", self.at, end) == end - self.at else 1
                edit = self.audit[self.at]
                if edit == "K":
                    self.write(role, text)
                    self.state = _AFTER[role[0]][self.state]
                elif edit == "R":
                    self.write(NEXT_ROLE[self.state], text)
                    self.state = _NEXT[self.state]
                self.at += run
                times -= run

        def close(self) -> tuple:
            self.insert()
            return self.conv_id, self.cost, self.audit, self.hash.hexdigest()

    for batch in batches:
        for conv_id, cost, audit, role, text, times in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "cost", "audit", "role", "text", "times")), strict=True):
            if audit is not None:
                if now is not None:
                    done.append(now.close())
                now = Open(conv_id, cost, audit)
            else:
                now.row(role, text, times)
        if len(done) >= 1024:
            yield batch_of(schema, [list(c) for c in zip(*done, strict=True)])
            done = []
    if now is not None:
        done.append(now.close())
    if done:
        yield batch_of(schema, [list(c) for c in zip(*done, strict=True)])


def hashed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with the SHA-256 of each conversation's repaired rows, ``role:text`` by line.

    A hash is a chain: a conversation's rows meet in one task, sorted by Spark and streamed through it.
    """
    lead = audited.select("conv_id", F.lit(0).alias("kind"), "cost", "audit")
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", "times")
    both = lines.unionByName(lead, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions(_order()[0], "kind", *_order()[1:])
    both = both.select("conv_id", "cost", "audit", "role", "text", "times")
    return both.mapInArrow(_hashed, "conv_id long, cost long, audit string, repaired_sha256 string")


def _tallied(pieces: DataFrame) -> DataFrame:
    """Faults of each conversation; pairs of roles across its pieces are counted as well."""
    borders = F.sort_array(F.collect_list(F.struct("part", "number", "first", "last")))
    across = F.size(F.filter(F.sequence(F.lit(1), F.size("borders")), lambda i: (i > 1) & ~F.concat(F.element_at("borders", F.greatest(i - 1, F.lit(1)))["last"], F.element_at("borders", i)["first"]).isin(*_ALLOWED)))
    out = pieces.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], borders.alias("borders"))
    return out.withColumn("illegal", F.col("illegal") + across).drop("borders")


def repaired(conversations: DataFrame, rows: DataFrame | None = None, most: int = PIECE) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every
    conversation; ``rows`` are its rows (conv_id, turn, role, text, times), by default as damaged."""
    rows = saved(faulty(damaged(conversations) if rows is None else rows))
    pieces = saved(cut_pieces(rows, most))
    found = hashed(rows, audits(pieces, learn(pieces)))
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    out = conversations.select(F.col("conv_id").cast("long")).distinct()
    for part in (gaps, _tallied(pieces), found):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
