"""The training-data operators against brute force, on awkward small inputs:
null and empty texts, ties, repeated rows, very long texts, extra columns."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationflow.llm import (
    edits, idfiles, jaccard, lines, packing, quality_rank, quality_rules, store, topk, toxicity, wordtable,
)
from stationflow.llm.idfiles import Encoding
from stationflow.llm.units import Units

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = "doc_id long, text string, lang string, h long, n long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

LONG = " ".join(f"word{i % 977} and {i}." for i in range(40_000))
BASE = " ".join(f"tok{i}" for i in range(60))
ROWS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "Hello  World's\n\nit's <|endoftext|> fine "), (5, BASE), (6, BASE.upper()),
    (7, BASE + " extra"), (8, BASE + " extra"), (9, "one two"), (10, "ONE two"), (11, "é́ nbsp x ½ 日本 😀"),
    (12, LONG), (12, LONG), (13, "shared line\n x \nshared line"), (None, "shared line\nno id here"), (14, " SHARED Line\r\nb"),
    (15, "same " * 50), (16, "a b c"), (17, "''s 's'll x 're  \n\n z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    store.ship(spark)
    return spark.createDataFrame([(i, t, "en", 1, 2) for i, t in ROWS], DOCS)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return docs.where("false")


def byte_ids(text, tokenizer=Tokenizer.from_file(BYTE)):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def word_ids(text, tokenizer=Tokenizer.from_file(WORD)):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_units_equal_the_library():
    rng = np.random.default_rng(3)
    texts = [t for _, t in ROWS] + ["".join(rng.choice(list("aB1 _'stmdrevl\n\t.,Àéß½́ <|\x1c"), 30)) for _ in range(3000)]
    for path, kind, want in ((BYTE, "byte", byte_ids), (WORD, "word", word_ids)):
        got = [ids[a:b].tolist() for _, ids, f in Units(path, kind).encode(pa.array(texts, pa.string()))
               for a, b in zip(f[:-1], f[1:])]
        assert got == [want(t) for t in texts]


def rules_brute(text):
    text = text or ""
    w = WORDS.findall(text)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    own = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(own) - len(set(own)), len(hit), failed)


def test_rules_counts(docs, empty):
    got = sorted(map(repr, (tuple(r)[:7] for r in quality_rules.judge(docs, quality_rules.Model(None)).collect())))
    assert got == sorted(repr((i, *rules_brute(t))) for i, t in ROWS)
    assert quality_rules.judge(empty, quality_rules.Model(None)).count() == 0
    kept = quality_rules.keep(docs, quality_rules.Model(None))
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    good = " ".join("the quiet river runs past old stone bridges toward sea".split()[::-1])
    rows, labels = [], []
    for i in range(400):
        bad, toxic = i % 3 == 0, i % 5 == 0
        text = ("!! ## %d || " % i) * 12 if bad else f"{good} {i} {good} near {i % 17}"
        rows.append((i, text + (" idiot scum" if toxic else ""), "en", 1, 2))
        labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 0), (1, None, None), (100_000, 0, 1)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_on_held_out_rows(labelled, docs, empty):
    rows, labels = labelled
    rank = quality_rank.op3_scores(rows, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(rank) > 50 and (rank.predicted == rank.quality).mean() > 0.95
    model = quality_rules.train(rows, labels.select("doc_id", F.col("quality").alias("label")))
    rules = quality_rules.judge(rows, model).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    assert ((rules.probability >= 0.5) == (rules.quality == 1)).mean() > 0.95
    tox = toxicity.op10_scores(rows, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(tox) > 50 and (tox.predicted == tox.toxic).mean() > 0.95
    for scored in (quality_rank.op3_scores(docs, labels), toxicity.op10_scores(docs, labels)):
        got = scored.toPandas()
        assert len(got) == len(ROWS) and got.score.between(0, 1).all()
    for scored in (quality_rank.op3_scores(empty, labels), toxicity.op10_scores(empty, labels)):
        assert scored.count() == 0
    none = labels.where("false")
    assert quality_rank.op3_scores(docs, none).count() == len(ROWS)
    assert toxicity.op10_scores(docs, none).where("predicted = 1").count() == 0


def test_maximal_segments_equal_the_definition():
    """Ruzzo and Tompa: take the best segment, then go on left and right of it."""
    def brute(v, base=0):
        best = max(((sum(v[i:j]), -(j - i), i, j) for i in range(len(v)) for j in range(i + 1, len(v) + 1)),
                   default=(0,))
        if best[0] <= 1e-12:
            return []
        _, _, i, j = best
        return brute(v[:i], base) + [(base + i, base + j - 1, round(best[0], 6))] + brute(v[j:], base + j)
    rng = np.random.default_rng(5)
    for _ in range(300):
        v = np.where(rng.random(14) < 0.5, rng.random(14) * 2, -rng.random(14) * 1.5)
        got = toxicity.maximal_segments(v)
        assert [(a, b, round(s, 6)) for a, b, s in got] == brute(v.tolist())


def test_id_files_round_trip(spark, docs, empty):
    got = [tuple(r) for r in idfiles.op2_token_files(spark, docs, Encoding(WORD, "word", 2)).collect()]
    start, want = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = word_ids(t) + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert idfiles.op2_token_files(spark, empty, Encoding(WORD, "word", 2)).count() == 0
    chunks, dictionary = idfiles.encode_documents(docs, Encoding(WORD, "word", 2))
    assert [a.tolist() for a in idfiles.read_document(chunks, dictionary, 5)] == [word_ids(BASE) + [2]]
    with pytest.raises(ValueError, match="another dictionary"):
        idfiles.Chunk(bytes(chunks.first().payload), dictionary + b"x")


def test_read_document_opens_only_chunks_with_its_id(spark, docs, monkeypatch):
    monkeypatch.setattr(idfiles, "CHUNK_BYTES", 1)      # a chunk for every document
    chunks, dictionary = idfiles.encode_documents(docs, Encoding(WORD, "word", 2))
    assert chunks.count() == len(ROWS)
    for doc_id in {i for i, _ in ROWS if i is not None}:
        want = [word_ids(t) + [2] for i, t in ROWS if i == doc_id]
        got = [a.tolist() for a in idfiles.read_document(chunks, dictionary, doc_id)]
        assert sorted(got) == sorted(want)
    # Payloads of other ids cannot be read at all; nor does the driver fetch any.
    broken = chunks.withColumn("payload", F.when(F.expr("first_id <=> 5 AND last_id <=> 5"), F.col("payload"))
                               .otherwise(F.lit(b"x")))
    monkeypatch.setattr(type(chunks), "toLocalIterator", None)
    assert [a.tolist() for a in idfiles.read_document(broken, dictionary, 5)] == [word_ids(BASE) + [2]]
    assert idfiles.read_document(broken, dictionary, 1 << 60) == []


def jaccard_brute(rows):
    sets = []
    for _, t in rows:
        w = [x.translate(LOW) for x in WORDS.findall(t or "")]
        sets.append(frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 90 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root[b] == root[a] and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None) if sets[a] else i))
    return out


def test_jaccard_components(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)        # several blocks per column
    rng = np.random.default_rng(1)
    near = [(100 + k, " ".join(w if rng.random() > 0.01 else "zz" for w in BASE.split() * 4)) for k in range(25)]
    rows = ROWS + near
    frame = spark.createDataFrame([(i, t, "en", 1, 2) for i, t in rows], DOCS)
    got = [tuple(r)[:3] for r in jaccard.op4_components(frame).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, jaccard_brute(rows)))
    assert jaccard.op4_components(empty).count() == 0
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    groups = {c for _, n, c in jaccard_brute(rows) if n}
    empties = sum(1 for _, n, _ in jaccard_brute(rows) if not n)
    assert kept.count() == len(groups) + empties
    pairs, members = jaccard.links(frame)
    assert pairs.count() > 0 and members.count() == len(rows)


def test_line_dedup(docs, empty):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    count = collections.Counter(k for _, t in ROWS for k in {key(x) for x in (t or "").split("\n")} - {""})
    want = []
    for i, t in ROWS:
        own = (t or "").split("\n")
        keep = [x for x in own if count[key(x)] < 3]
        want.append((i, len(own), len(own) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    got = [tuple(r) for r in lines.op5_lines(docs, min_docs=3).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(w[2] for w in want)
    assert lines.op5_lines(empty).count() == 0
    assert lines.drop_common_lines(docs, 3).columns == [*docs.columns, "_n_lines", "_n_dropped"]


def test_line_runs_compact(spark):
    runs = lines.LineRuns(spark, fan_in=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(1, 1, 1), (k, 2, 1)], "h1 long, h2 long, n long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert {tuple(r) for r in runs.counts().where("h2 = 1").collect()} == {(1, 1, 5)}


def test_unseen_lines_go_batch_by_batch(spark, docs, empty):
    """Each batch joins the runs of the earlier ones; the first holder keeps a line."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    batches = [docs.where("doc_id <= 7"), empty, docs.where("doc_id > 7 OR doc_id IS NULL"), docs.where("doc_id = 13")]
    runs, seen = lines.LineRuns(spark, fan_in=2), set()
    for b in batches:
        b = b.dropDuplicates(["doc_id", "text"]).withColumnRenamed("h", "_keep")
        want, own_seen = [], set()
        for r in sorted(b.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)):
            own = (r.text or "").split("\n")
            keep = []
            for x in own:
                if not key(x) or key(x) not in seen | own_seen:
                    keep.append(x)
                if key(x):
                    own_seen.add(key(x))
            want.append((r.doc_id, "\n".join(keep), len(own), len(own) - len(keep)))
        seen |= own_seen
        out = lines.drop_seen_lines(b, runs)
        assert out.columns == [*b.columns, "_n_lines", "_n_dropped"]
        got = out.select("doc_id", "text", "_n_lines", "_n_dropped").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert runs.counts().count() == len(seen) and len(runs.levels) > 1


def test_stored_trees_take_further_edits(spark, docs, empty):
    """Trees are stored; a later batch of edits reads its regions only."""
    enc = Encoding(BYTE, "byte")
    stored = store.saved(edits.token_trees(docs, enc), "trees")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: "".join(r.segments) for r in stored.collect()} == texts
    batches = [{5: [(3, 4, "x y"), (0, 0, "<|endoftext|>")], 12: [(200_000, 9, " new")], 99: [(0, 0, "nobody")]},
               {5: [(1, 1, "")], 1: [(0, 0, "was null")], 12: [(0, 0, "a"), (10**9, 5, " end")]}, {}]
    for batch in batches:
        given = spark.createDataFrame([(i, e) for i, e in batch.items()], f"doc_id long, edits {edits.EDITS_TYPE}")
        after = store.saved(edits.edit_trees(edits.with_edits(stored, given), enc), "trees")
        for i, es in batch.items():
            for pos, cut, ins in es:
                if i in texts:
                    pos = min(pos, len(texts[i]))
                    texts[i] = texts[i][:pos] + ins + texts[i][pos + cut:]
        rows = after.collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            assert "".join(r.segments) == texts[r.doc_id] and r.n_chars == len(texts[r.doc_id])
            assert r.n_after == sum(r.tokens) == len(byte_ids(texts[r.doc_id]))
            assert r.n_encoded_chars < 3000 and (r.n_edits > 0) == (r.doc_id in batch)
        stored = after.select("doc_id", "segments", "tokens")
    assert edits.token_trees(empty, enc).count() == 0


def test_edit_counts(docs, empty):
    frame = docs.withColumn("edits", edits.derived_edits())
    odd = frame.limit(1).withColumn("edits", F.lit(None).cast(edits.EDITS_TYPE))
    every = frame.unionByName(odd).collect()
    got = edits.count_edited(frame.unionByName(odd), Encoding(BYTE, "byte")).collect()
    want = []
    for r in every:
        t = r.text or ""
        for e in r.edits or []:
            t = t[:e.pos] + (e.ins or "") + t[e.pos + e["del"]:]
        want.append((r.doc_id, len(byte_ids(r.text)), len(byte_ids(t)), len(t)))
    assert sorted(repr((r.doc_id, r.n_before, r.n_after, r.n_chars)) for r in got) == sorted(map(repr, want))
    assert edits.count_edited(empty.withColumn("edits", edits.derived_edits()), Encoding(BYTE, "byte")).count() == 0
    # The same edits in two batches on stored trees.
    plain = edits.count_edited(frame, Encoding(BYTE, "byte")).drop("n_encoded_chars")
    clashing = docs.withColumn("pending", F.lit(1)).withColumn("edits", F.lit("x"))
    stored = edits.op6_counts(clashing, Encoding(BYTE, "byte")).drop("n_encoded_chars")
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, plain.collect()))
    assert edits.op6_counts(empty, Encoding(BYTE, "byte")).count() == 0


def test_many_edits_near_boundaries():
    units = Units(BYTE, "byte")
    rng = np.random.default_rng(2)
    text = " ".join(f"word{i}'s x{i}." for i in range(200))
    tree = edits.trees(units, next(iter(edits.T.slices(pa.array([text])))))[0]
    assert len(tree.texts) > 5
    for _ in range(200):
        pos, cut = int(rng.integers(0, len(text) + 1)), int(rng.integers(0, 9))
        cut = min(cut, len(text) - pos)
        ins = ["", " ", "'ll", "a b", "<|endoftext|>", "\n\n"][int(rng.integers(0, 6))]
        edits.apply_edits(units, [tree], [[{"pos": pos, "del": cut, "ins": ins}]])
        text = text[:pos] + ins + text[pos + cut:]
        assert tree.text == text and tree.total == len(byte_ids(text))


def test_packing(docs, empty):
    held, placed = packing.pack_documents(docs, Encoding(BYTE, "byte", 2), capacity=64)
    rows = placed.collect()
    assert sum(r.length for r in rows) == sum(len(byte_ids(t)) + 1 for _, t in ROWS)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    first = {(r.doc_id, r.start): r for r in rows}
    ids = byte_ids(BASE) + [2]
    r = first[(5, 0)]
    assert r.length == (len(ids) % 64 or 64) and r.ids_crc32 == zlib.crc32(np.array(ids[:r.length], "<u4").tobytes())
    assert packing.sequences(held, placed).count() == len(by)
    assert packing.pack_documents(empty, Encoding(BYTE, "byte", 2))[1].count() == 0


def test_plan_holds_every_piece_and_is_near_the_bound():
    rng = np.random.default_rng(0)
    hist = np.bincount(rng.integers(1, 1025, 20_000), minlength=1025)
    planned = packing.plan(hist)
    used = np.zeros(1025, int)
    for p, n in planned:
        assert sum(p) <= 1024
        for v in p:
            used[v] += n
    assert (used == hist).all()
    assert sum(n for _, n in planned) <= 1.02 * (hist * np.arange(1025)).sum() / 1024


@pytest.mark.parametrize("head", [1_000_000, 5, 0])
def test_word_table(docs, empty, head):
    tokenizer = Tokenizer.from_file(BYTE)
    got = [tuple(r) for r in wordtable.op8_digests(docs, Encoding(BYTE, "byte"), head).collect()]
    want = []
    for i, t in ROWS:
        ids = byte_ids(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert wordtable.op8_digests(empty, Encoding(BYTE, "byte"), head).count() == 0


def test_head_is_bounded_by_bytes(spark):
    texts = [f"n\u00a0{i} " + "many words of one text " * 40 for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "a b c") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoding, tokenizer = Encoding(BYTE, "byte"), Tokenizer.from_file(BYTE)
    table = wordtable.word_table(docs, encoding)
    assert table.where(F.octet_length("word") > 900).count() == 60
    top = table.where(wordtable.head_rule(table, 1000))
    assert top.agg(F.sum(F.octet_length("word"))).first()[0] <= 1000 * wordtable.LONG_SHARE + 1000 * wordtable.SHORT_BYTES
    assert top.count() == table.count() - 60
    # With room for them, long words are in the head as well.
    assert table.where(wordtable.head_rule(table, 10_000)).count() == table.count()
    _, head = wordtable.skeletons(docs, encoding, 1000)
    assert len(head.value.hash) == top.count()
    got = {r.doc_id: tuple(r)[1:] for r in wordtable.op8_digests(docs, encoding, 1000).collect()}
    for i, t in rows:
        ids = byte_ids(t)
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_ranks_of_every_size_come_back():
    edges = [0, 159, 160, 255, 256, wordtable.FAR - 1, wordtable.FAR, wordtable.MOST_RANKS - 1]
    mixed = np.random.default_rng(1).integers(0, wordtable.MOST_RANKS, 5000)
    for ranks in (np.array(edges), mixed, np.zeros(0, np.int64), np.full(3000, wordtable.FAR)):
        raw = wordtable.Head.skeleton(None, ranks)
        assert wordtable.Head.ranks(None, raw).tolist() == ranks.tolist()


def test_models_repeat(spark):
    """Equal rows give equal weights, whatever their order and partitions."""
    from stationflow.llm import hashed, quality_rules as Q
    rows = [(i, f"{'good fine' if i % 2 else 'bad poor'} text number {i} " * 5, i % 2) for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    fit = lambda t: hashed.fit(t, Q.FAMILIES, hashed.logistic_steps, hashed.logistic_slope)
    first = fit(train)
    assert np.abs(first).max() > 0
    assert np.array_equal(first, fit(train.orderBy(F.desc("doc_id")).repartition(7)))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    monkeypatch.setattr(topk, "QUERY_ROWS", 1)
    monkeypatch.setattr(topk, "GROUPS", 2)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(120)]
    vectors += [(200, None), (250, [1.0, None, 0.0, 0.0]), (300, [float("nan")] * 4), (301, [float("inf")] * 4),
                (None, [1.0] * 4), (350, []), (400, [1.0, 2.0]), (401, [3.0, 1.0]), (7, vectors[7][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<float>, score int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.op9_search(frame).collect()}
    usable = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in vectors
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for i, q in usable:
        if i % 50 == 0:
            best = sorted((-int(q @ c), j) for j, c in usable if j != i and len(c) == len(q))[:5]
            want |= {(i, k + 1): (j, -s) for k, (s, j) in enumerate(best)}
    assert got == want
    assert topk.op9_search(frame.where("false")).count() == 0


def test_products_stay_exact():
    big = np.array([[1 << 30, 3]], np.int64)
    assert topk.products(big, big)[0, 0] == (1 << 60) + 9
    with pytest.raises(ValueError):
        topk.products(big << 2, big)
