"""The operators against brute force, exact round trips and held-out accuracy."""

import collections
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from airwave.llm import chat_format, decontamination, language_id, near_dedup, nearest, packing, pii, sharding, token_counts, toxicity
from airwave.llm.common import held_out, saved, text_bytes
from airwave.llm.queries import QUERIES
from airwave.llm.tokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_tokens_are_the_librarys_own():
    random.seed(1)
    parts = ["'s", "'re", "'ll", "'", "a", "b", " ", "  ", "\n", "\n\n", "\t", "1", "23", "!?", "é", "ß", "×", "“x”", "<|endoftext|>", "漢", "\r\n"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(3000)] + ["", "it's\x1cx"]
    t = tokenizer(PATH)
    for group in (texts, [x for x in texts if not set(x) & set("×“漢\x1c")]):
        ids, at = t.encode(*text_bytes(pa.array(group)))
        for i, own in enumerate(t.whole(group)):
            assert np.array_equal(ids[at[i] : at[i + 1]], own), group[i]


def test_packing(spark, docs, odd_docs):
    for rows in (docs, odd_docs):
        got = packing.packed(rows, PATH).toPandas()
        texts = [r["text"] or "" for r in rows.collect()]
        lengths = [len(x) + 1 for x in tokenizer(PATH).whole(texts)]
        assert got["length"].sum() == sum(lengths)
        for _, own in got.groupby("sequence_id"):
            own = own.sort_values("offset")
            assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= 1024
    got = packing.packed(docs, PATH).toPandas()
    for r in docs.collect()[:20]:
        ids = np.append(tokenizer(PATH).whole([r["text"]])[0], 0).astype("<u4")
        for p in got[got["doc_id"] == r["doc_id"]].itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    full = packing.pack(packing.pieces(docs.limit(5), PATH, 64, True), 64)
    assert {len(r["ids"]) for r in packing.sequences(full, 64).collect()} == {64}
    assert packing.packed(docs.where("false"), PATH).count() == 0


def test_packed_pieces_bring_their_ids(spark, docs, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(packing, "GROUP_IDS", 5000)
    rows = docs.limit(60)
    got = packing.packed(rows, PATH, 256).toPandas().sort_values(["doc_id", "start"])
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for doc_id, own in got.groupby("doc_id"):
        whole = np.append(tokenizer(PATH).whole([texts[doc_id]])[0], packing.END_ID)
        assert np.array_equal(np.concatenate(own["ids"].tolist()), whole)
    full = packing.sequences(packing.packed(rows, PATH, 256), 256).collect()
    assert {len(r["ids"]) for r in full} == {256} and len(full) == got["sequence_id"].nunique()
    last = dict(corpus_pipeline.STAGES)["packing"](spark, rows, SF)
    assert last.count() and last.where("size(ids) = length").count() == last.count()
    by_id = {r["sequence_id"]: r["ids"] for r in full}
    assert all(by_id[p.sequence_id][p.offset : p.offset + p.length] == list(p.ids) for p in got.itertuples())


def test_placements_hold_every_piece():
    random.seed(2)
    histogram = collections.Counter(random.choices(range(1, 65), k=5000))
    at = packing.place(histogram, 64)
    room = collections.Counter()
    for p in at.itertuples():
        for k in range(p.n):
            assert room[p.sequence + k] == p.offset
            room[p.sequence + k] += p.size
    assert at.groupby("size")["n"].sum().to_dict() == dict(histogram) and max(room.values()) <= 64
    assert sum(room.values()) > 0.95 * 64 * len(room)


def test_token_counts(spark, docs, odd_docs):
    for rows in (docs, odd_docs):
        got = token_counts.count_documents(rows, PATH, block=1000).toPandas()
        lengths = [len(x) for x in tokenizer(PATH).whole([r["text"] or "" for r in rows.collect()])]
        assert sorted(got["n_tokens"]) == sorted(lengths) and got["complete"].all()
    assert token_counts.count_documents(docs.where("false"), PATH).count() == 0


def test_scan_finds_the_tail(spark, tmp_path):
    np.array([5, 9, 5, 5, 9, 7], "<u2").tofile(tmp_path / "a.bin")
    got = token_counts.scan(token_counts.blocks(spark, f"file://{tmp_path}", block=2), separator=9).orderBy("ordinal").collect()
    assert [(r["start"], r["n_tokens"], r["complete"]) for r in got] == [(0, 1, True), (2, 2, True), (5, 1, False)]


def test_shards(spark, docs, odd_docs):
    for rows, n in ((docs, 4), (odd_docs, 3)):
        keyed = rows.select("doc_id", sharding.record_size(F.col("text")).alias("size"), sharding.record_key(F.col("text"), F.col("doc_id")).alias("key"))
        got = sharding.shard(keyed, n, ranges=16).toPandas()
        assert len(got) == rows.count() and got["shard"].between(0, n - 1).all()
        for _, own in got.groupby("shard"):
            assert sorted(own["slot"]) == list(range(len(own)))
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size"), sharding.record_key(F.lit("same"), F.col("id")).alias("key"))
    sizes = sharding.shard(hot, 4, ranges=64).groupBy("shard").agg(F.sum("size")).collect()
    assert {r[1] for r in sizes} <= set(range(9900, 10101)) and len(sizes) == 4
    assert sharding.shard(hot.where("false"), 4).count() == 0


def _components(rows):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {d: new if x == old else x for d, x in label.items()}
    return {d: (len(sets[d]), label[d]) for d in sets}


def test_near_dedup(spark, docs, odd_docs):
    random.seed(3)
    base = [f"w{i}" for i in range(300)]
    copies = []
    for k in range(60):  # a star: copies near the first text, not near each other
        words = list(base)
        for at in random.sample(range(300), 6):
            words[at] = f"x{k}{at}"
        copies.append((10_000 + k, " ".join(words)))
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9_999, " ".join(base)), *copies], "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.components(rows).collect()}
    assert got == _components([tuple(r) for r in rows.collect()])
    odd = near_dedup.components(odd_docs).toPandas()
    assert len(odd) == odd_docs.count() and near_dedup.one_of_each(odd_docs).count() == 7
    assert near_dedup.components(docs.where("false")).count() == 0


@pytest.mark.parametrize("n", [2, 3, 8, 20])
def test_neighbours_meet_across_partitions(spark, monkeypatch, n):
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(base[:197] + [f"x{k}"])) for k in range(n)]
    nodes = saved(near_dedup.signed(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("label", F.col("node")))

    def pairs():
        every, weights = near_dedup.candidates(nodes)
        next_ones, same = near_dedup.candidates(nodes, 1)
        every, next_ones, weights, same = ({tuple(r) for r in x.collect()} for x in (every, next_ones, weights, same))
        assert weights == same and next_ones <= every
        assert {node for node, _ in weights} == {x for a, b, _ in every for x in (a, b)}
        return every

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        whole = pairs()
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert pairs() == whole and len(whole) >= n - 1
        monkeypatch.setattr(near_dedup, "ROWS_PER_PART", 1)
        assert pairs() == whole
        one = nodes.withColumn("label", F.lit(1).cast("long"))
        assert near_dedup.candidates(one)[0].isEmpty()  # one component: nothing is left to find
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_row_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(100))
    near, other, third = text + " more", " ".join(f"v{i}" for i in range(50)), " ".join(f"u{i}" for i in range(50))
    rows = spark.createDataFrame(
        [(None, text, "x"), (7, text, "x"), (5, near, "x"), (5, text, "x"), (None, near, "x"),  # one group
         (None, other, "x"), (None, other, "y"), (None, other + " more", "x"),  # no id in the group
         (9, third, "x"), (9, third, "x"), (9, third, "y"),  # repeated
         (None, "", "x"), (None, "", "x"), (3, "", "x"), (3, "", "x"), (4, None, "x")],
        "doc_id long, text string, source string",
    )
    got = near_dedup.one_of_each(rows, repeated=False)
    assert got.columns == rows.columns
    left = collections.Counter((r["doc_id"], (r["text"] or "")[:2]) for r in got.collect())
    assert left == {(5, "w0"): 1, (None, "v0"): 1, (9, "u0"): 1, (None, ""): 2, (3, ""): 1, (4, ""): 1}
    left = collections.Counter((r["doc_id"], (r["text"] or "")[:2]) for r in near_dedup.one_of_each(rows).collect())
    assert left == {(5, "w0"): 1, (None, "v0"): 1, (9, "u0"): 3, (None, ""): 2, (3, ""): 2, (4, ""): 1}


def test_connected_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.connected(edges).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def test_decontamination(spark, docs, odd_docs):
    random.seed(4)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: r["text"].lower() for r in bench.collect()}
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items() if t in r["text"].lower()}
    assert got >= exact
    planted = []
    for n, (i, text) in enumerate(items.items()):
        words = text.split()
        for _ in range(len(words) // 8):
            words[random.randrange(len(words))] = "changed"
        planted.append((i, f"{'before ' * (n % 7)}{' '.join(words)} after it"))
    found = decontamination.leaks(spark.createDataFrame(planted, "doc_id long, text string"), bench).toPandas()
    assert (found["doc_id"] == found["item_id"]).sum() >= decontamination.RECALL * len(items)
    assert decontamination.marked(odd_docs, bench).count() == 7
    assert decontamination.clean(odd_docs, bench).columns == odd_docs.columns
    assert decontamination.leaks(docs, bench.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["other", "more", "less", "mixed"])
@pytest.mark.parametrize("length", [5, 10, 20, 41, 57, 100, 300])
def test_decontamination_recall_at_most_edits(length, kind):
    rng = random.Random(length)
    word = lambda: f"w{rng.randrange(10**6)}"
    items = [[word() for _ in range(length)] for _ in range(60)]
    texts = []
    for item in items:
        own = list(item)
        for at in sorted(rng.sample(range(length), int(decontamination.EDITS * length)), reverse=True):
            edit = rng.choice(["other", "more", "less"]) if kind == "mixed" else kind
            own[at : at + (edit != "more")] = [word()] * (edit != "less")
        texts.append(" ".join(["before"] * 7 + own + ["after"] * 9))
    block = decontamination.Block(list(range(60)), [" ".join(x) for x in items])
    found = block.find(*[decontamination.words(*text_bytes(pa.array(texts)), decontamination.APART)[k] for k in (0, 3)])
    assert sum(any(x["item_id"] == i for x in own) for i, own in enumerate(found)) >= decontamination.RECALL * 60


def test_language(spark, docs, odd_docs):
    model = language_id.train(docs)
    rows = language_id.identified(docs.withColumn("held", held_out()), model).toPandas()
    held = rows[rows["held"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95 and rows["lang_rejected"].mean() < 0.02
    odd = language_id.identified(odd_docs, model).toPandas()
    assert set(odd.loc[odd["text"].isin(["", "12 34 !!"]) | odd["text"].isna(), "lang_pred"]) == {"und"}
    junk = spark.createDataFrame([(1, "Привет мир как дела сегодня хорошо")], "doc_id long, text string")
    assert language_id.identified(junk, model).first()["lang_rejected"]
    assert language_id.train(docs.where("false")) is None
    assert language_id.identified(docs, None).where("lang_pred != 'und'").isEmpty()


def test_kneser_ney_sums_to_one():
    model = language_id.fit(pd.DataFrame({"lang": ["a"] * 8, "text": ["abra cadabra"] * 8}))
    for context in ("abr", "zzz", "cad"):
        letters = [chr(c) for c in model_letters(model)] + ["\x00"]
        total = 0.0
        for c in letters:
            text = (context + c).replace("\x00", " ")
            bits, size = model.costs(*language_id.characters(*text_bytes(pa.array([text + ("" if c != "\x00" else "")]))))
            base, _ = model.costs(*language_id.characters(*text_bytes(pa.array([context]))))
            total += 2 ** -(bits - base)[0, 0]
        assert total <= 1.0 + 1e-6


def model_letters(model):
    return [ord(c) for c in "abrcd"]


def test_toxicity(spark, docs, odd_docs):
    rng = np.random.RandomState(0)
    words = [f"w{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        own = list(rng.choice(words, 30)) + (["vile"] if toxic else [])
        texts.append((i, " ".join(own), "en"))
        labels.append((i, 0, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    net = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = toxicity.scored(docs.withColumn("held", held_out()), net).toPandas()
    held = got[got["held"]]
    assert ((held["tox_score"] >= 0.5) == (held["doc_id"] % 4 == 0)).mean() > 0.95
    assert toxicity.scored(odd_docs, net).where("tox_score between 0 and 1").count() == 7
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, none) is None and toxicity.scored(docs, None).where("tox_score = 0").count() == 400


def test_toxicity_learns_from_all_labelled_texts(spark, monkeypatch):
    """Each toxic word is in one text only; one text is longer than any that was learned from before."""
    monkeypatch.setattr(toxicity, "PART_ROWS", 700)
    n = 2_600
    rng = np.random.RandomState(2)
    rows, long = [], next(i for i in range(1, n) if zlib.crc32(str(i).encode()) % 5)
    for i in range(n):
        own = [f"w{j}" for j in rng.randint(0, 300, 12)] + ([f"vile{i}"] if i % 2 else [])
        rows.append((i, " ".join(own) + (" w1" * 8_000 if i == long else ""), "en", i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(4).cache()
    net = toxicity.train(docs, docs.select("doc_id", "toxic"))
    new = toxicity._new()
    texts = docs.where(~held_out() & ~(F.pmod(F.xxhash64(F.lit("kept"), "doc_id"), F.lit(toxicity.CALIBRATION)) == 1)).where("toxic = 1").toPandas()
    word, _ = toxicity.buckets(*text_bytes(pa.array([f"vile{i}" for i in texts["doc_id"]])))
    # A word that never gives a filter's largest response has no gradient: a few stay as they were.
    assert len(word) > 800 and (net.embed[word] != new.embed[word].astype(np.float32)).any(1).mean() > 0.95
    again = toxicity.train(docs.repartition(3), docs.select("doc_id", "toxic"))
    assert (again.embed == net.embed).all() and (again.threshold == net.threshold).all() and (again.profile == net.profile).all()
    # Word counts are those of all learnable texts.
    words = docs.where(~held_out()).select(F.explode(F.split("text", " "))).count()
    bucket, _ = toxicity.buckets(*text_bytes(pa.array(["w1"])))
    ones = docs.where(~held_out()).select(F.explode(F.split("text", " ")).alias("w")).where("w = 'w1'").count()
    assert abs(np.exp(net.profile[bucket[0], 0]) / ((ones + 0.1) / (words + 0.1 * toxicity.BUCKETS)) - 1) < 0.01


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def _plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(np.array([*map(int, digits)]))):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out)


def test_pii_base_spans_are_the_patterns():
    random.seed(0)
    parts = ["1", "22", "333", ".", "..", "@", "+", " ", "-", "(", ")", "a", "b.c", "é", "x@y.z", "1.2.3.4", "256.1.1.1", "+1 555 123 4567", "4111 1111 1111 1111", "%", "漢"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(5000)]
    base, every = pii.search(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    for text, own, more in zip(texts, base, every, strict=True):
        assert own == _plain(text) and set(own) <= set(more)


@pytest.mark.parametrize("text, hidden", [
    ("mail jane.doe [at] example [dot] com now", "jane.doe [at] example [dot] com"),
    ("jane dot doe at example dot com", "jane dot doe at example dot com"),
    ("so jаne@exаmple.com", "jаne@exаmple.com"),
    ("call plus one five five five one two three four now", "plus one five five five one two three four"),
    ("ip 192[.]168[.]1[.]20 x", "192[.]168[.]1[.]20"),
    ("user＠example．com", "user＠example．com"),
    ("+４４ ２０ 7946 0958", "+４４ ２０ 7946 0958"),
    ("meet me at home. dot the i", None),
])
def test_pii_in_disguise(text, hidden):
    _, (spans,) = pii.search(pa.RecordBatch.from_arrays([pa.array([text])], names=["text"]))
    assert [text[a:b] for _, a, b in spans] == ([hidden] if hidden else [])


def _rewritten(texts):
    return pii.search(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))[1]


def test_pii_each_sign_alone_triggers_the_rewrite():
    signs = pa.array([chr(sign) for sign in pii._SIGN_TABLE])
    assert all(pii.pc.match_substring_regex(signs, pii.SIGNS, ignore_case=True).to_pylist())
    hidden = {sign: "jane@example{}com" if plain == "." else "jane{}example.com" if plain == "@" else "{}@example.com"
              for sign, plain in pii._SIGN_TABLE.items() if plain.isalnum() or plain in ".@"}
    texts = [form.format(chr(sign)) for sign, form in hidden.items()]
    for text, spans in zip(texts, _rewritten(texts), strict=True):
        assert [text[a:b] for _, a, b in spans] == [text], text
    for between in (" ", ".", "(", ")", "_", "_dot_", " dot ", "·"):
        text = "call +" + between.join(["five"] * 8) + " now"
        assert [k for k, _, _ in _rewritten([text])[0] if k == 3] == [3], between


@pytest.mark.parametrize("piece,ending", [
    (" ", "jane [at] x [dot] org"), ("a", "@"), ("1", ".1"), (".", "α"), ("[ ", "α"), ("a@", "α"), ("1 ", "one two"), ("+ ", "α"),
    ("jane at x ", "dot org"), (" ", "α jane dot   smith at x dot org"), ("a@b.co ", "jane at x dot org"), ("1.1.1.1 ", "\u00ad"),
])
def test_pii_takes_linear_time(piece, ending):
    text = piece * (3_000_000 // len(piece)) + ending
    began = time.process_time()
    _, (spans,) = pii.search(pa.RecordBatch.from_arrays([pa.array([text])], names=["text"]))
    assert time.process_time() - began < 60
    if "org" in ending and piece != "jane at x ":
        kind, start, end = spans[-1] if piece == " " else max(spans, key=lambda x: x[1])
        assert kind == 0 and end == len(text) and text[start:].startswith("jane")


def test_pii_addresses_that_follow_each_other():
    random.seed(6)
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(random.choices("ab1@._-é ", weights=[3, 2, 3, 3, 4, 1, 1, 1, 1], k=random.randint(0, 30)))
        (base,), _ = pii.search(pa.RecordBatch.from_arrays([pa.array([text])], names=["text"]))
        assert [(a, b) for k, a, b in base if k == 0] == [m.span() for m in pattern.finditer(text)], text
        assert [(a, b) for k, a, b in base if k == 1] == [m.span() for m in ip.finditer(text)], text


def test_pii_redacted(spark, odd_docs):
    rows = spark.createDataFrame([(1, "é a@b.cd and 1.2.3.4", 20), (2, None, None)], "doc_id long, text string, n_chars long")
    got = pii.redacted(rows).orderBy("doc_id").collect()
    assert got[0]["text"] == "é [EMAIL] and [IP]" and got[0]["n_chars"] == 18 and got[1]["text"] is None
    assert pii.found(odd_docs).count() == 7 and pii.redacted(odd_docs).count() == 7


def test_chat_parts(spark):
    rows = spark.sql(f"""
        SELECT 1L AS conv_id, t.* FROM VALUES
        (0L, 'user', from_json('[{{"type":"text","text":"<end> & see "}},{{"type":"image","ref":"a.png","width":56,"height":30}},{{"type":"text","text":"!"}}]', '{chat_format.PARTS}')),
        (1L, 'assistant', from_json('[{{"type":"audio","ref":"b.wav","seconds":1.5}},{{"type":"text","text":"ok"}}]', '{chat_format.PARTS}')),
        (2L, null, null) AS t(turn, role, parts)""")
    got = chat_format.formatted(rows).first()
    assert got["formatted"] == "<turn:user>&lend&g &a see <image:1>!<end><turn:assistant><audio:2>ok<end><turn:><end>"
    assert [(a["number"], a["kind"], a["ref"], a["tokens"], a["turn"]) for a in got["attachments"]] == [(1, "image", "a.png", 4, 0), (2, "audio", "b.wav", 38, 1)]
    assert got["attachment_tokens"] == 42
    (mask,) = got["loss_mask"]
    assert got["formatted"][mask["start"] : mask["end"]] == "<audio:2>ok"
    back = chat_format.formatted(rows).select(chat_format.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert back[0]["text"] == "<end> & see <image:1>!" and back[2] == ("", "")


def test_nearest(spark):
    rng = np.random.RandomState(1)
    x = rng.normal(size=(3000, 8)).round(2)
    x[100:900] = x[100]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3001, [0.0] * 8), (3002, [float("nan")] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 50 = 0")
    exact = {}
    for q in range(0, 3000, 50):
        score = nearest.cosines(np.repeat(x[q : q + 1], 3000, 0), x)
        score[q] = -2
        exact[q] = np.lexsort((np.arange(3000), -score))[:5].tolist()
    for factor, least in ((1.0, 1.0), (1.3, 0.9)):
        got = nearest.neighbours(vectors, queries, 5, factor, 500).toPandas().sort_values(["query_id", "rank"])
        found = got.groupby("query_id")["vec_id"].apply(list).to_dict()
        assert np.mean([len(set(found[q]) & set(own)) / 5 for q, own in exact.items()]) >= least
        if factor == 1.0:
            assert found == exact
    assert nearest.neighbours(vectors.where("false"), queries.where("false")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    got = QUERIES["pipeline"](spark, SF)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
