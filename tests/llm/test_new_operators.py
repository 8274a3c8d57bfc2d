"""Merkle manifest, min-max near duplicates and collocations against plain Python, on
awkward small inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import time
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationflow.llm import collocations, jaccard, lines, merkle, minmax, store, toxicity
from stationflow.llm import textarrays as T
from test_operators import BASE, LOW, ROWS, WORDS

# Columns that are named like the operators' own.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, s1 long, grp string, "
          "size long, block long, copies string, part int, salt int, _salt int, _hot boolean")
CLASH = (1, 2, "g", 3, 4, "c", 5, 6, 7, True)
SOURCES = ["src", None, "", "é", "src\n"]


def rows():
    return [(i, t, [None, "en", "de"][k % 3], SOURCES[k * k % 5], None if k % 4 == 0 else k) for k, (i, t) in enumerate(ROWS)]


@pytest.fixture(scope="module")
def docs(spark):
    store.ship(spark)
    return spark.createDataFrame([r + CLASH for r in rows()], SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


# --- operator 11 -------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    for nodes in levels[:-1]:
        run = at - at % 3
        yield nodes[run:at], nodes[at + 1:run + 3]
        at //= 3


def merkle_brute(given):
    """given: (doc_id, text, lang, source, n_chars)."""
    groups = collections.defaultdict(list)
    for i, text, lang, source, n in given:
        own = row_leaf((i, source, lang, n, text))
        cut = text
        if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None:
            cut = text.replace("\n", "")
        groups["" if source is None else "=" + source].append((i, own, row_leaf((i, source, lang, n, cut))))
    names = sorted(groups, key=str.encode)
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree_of([own for _, own, _ in groups[g]])
    top = tree_of([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (i, own, new) in enumerate(groups[g]):
            path = [*siblings(trees[g], at), *siblings(top, k)]
            reached = new
            for left, right in path:
                reached = digest(*left, reached, *right)
            proof = digest(*(d for left, right in path for d in left + right))
            out.append((i, own, trees[g][-1][0], top[-1][0], proof, reached, reached == top[-1][0]))
    return out


def test_manifest(docs, empty):
    got = merkle.op11_rows(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, merkle_brute(rows())))
    assert merkle.op11_rows(empty).count() == 0
    one = docs.where("doc_id = 4")
    only = merkle.op11_rows(one).first()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == digest()


def test_manifest_of_several_rounds_of_blocks(spark, monkeypatch):
    """More leaves than a block holds, of one hot group and many small ones."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    given = [(i, f"line {i % 7}\nend", "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(700)]
    given += [(5, None, None, "hot", 1), (5, "a\nb", None, "hot", 1)]
    frame = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.op11_rows(frame).collect()
    want = merkle_brute(given)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert 0 < sum(r.verified for r in got) < len(got)


def test_versions_share_all_but_their_path(spark):
    leaves = [f"{i:064x}" for i in range(27)]
    tree = merkle.block_tree(leaves, None)
    before = [list(level) for level in tree]
    copies = merkle.copied_path(tree, 13, "f" * 64)
    assert tree == before and len(copies) == len(tree)
    changed = merkle.block_tree([*leaves[:13], "f" * 64, *leaves[14:]], None)
    differ = [[i for i, (a, b) in enumerate(zip(x, y)) if a != b] for x, y in zip(tree, changed)]
    assert differ == [[13], [4], [1], [0]]
    assert copies == [changed[0][13], changed[1][4], changed[2][1], changed[3][0]]
    frame = spark.createDataFrame([("g", i, d, "f" * 64 if i == 13 else None) for i, d in enumerate(leaves)],
                                  "grp string, key long, digest string, changed string")
    nodes = merkle.copied_nodes(merkle.manifest(frame)).orderBy("level").collect()
    assert [n.digest for n in nodes] == copies and {n.key for n in nodes} == {13}


# --- operator 12 -------------------------------------------------------------------


def shingles(text, n=3):
    w = WORDS.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def linked_brute(given, percent):
    sets = [shingles(t) for _, t in given]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(given)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(given):
        ids = [given[j][0] for j in range(len(given)) if find(j) == find(i) and given[j][0] is not None]
        least = min(ids, default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(map(repr, out))


def test_near_duplicates(docs, empty):
    got = minmax.op12_rows(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(repr, map(tuple, got.collect()))) == linked_brute(ROWS, minmax.PERCENT)
    assert minmax.op12_rows(empty).count() == 0


def test_near_duplicates_of_groups_and_chains(spark, monkeypatch):
    """A large group of near copies, chains just above and below the threshold, and
    texts that share half of their words; small blocks, so that tiles are split."""
    monkeypatch.setattr(minmax, "BLOCK", 8)
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in rng.integers(0, 10_000, 300)]
    given = []
    for i in range(60):                                         # near copies of one text
        own = list(base)
        own[int(rng.integers(0, 300))] = f"n{i}"
        given.append((i, " ".join(own)))
    half = [f"h{k}" for k in range(60)]
    for i in range(60, 100):                                    # a shared half: no link
        given.append((i, " ".join(half + [f"x{i}_{k}" for k in range(60)])))
    chain = [f"c{k}" for k in range(200)]
    for i in range(100, 130):                                   # each a little further on
        given.append((i, " ".join(chain)))
        at = (i - 100) * 6 % 190
        for k in range(at, at + int(rng.integers(1, 16))):
            chain[min(k, 199)] = f"z{i}_{k}"
    given += [(None, given[3][1]), (200, given[3][1]), (201, given[61][1].upper())]
    got = minmax.op12_rows(spark.createDataFrame(given, "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, got.collect()))) == linked_brute(given, minmax.PERCENT)


def test_signatures_are_unbiased_and_band_misses_are_rare():
    rng = np.random.default_rng(9)
    shares, misses = [], 0
    for _ in range(300):
        every = rng.integers(0, 1 << 63, 230, dtype=np.uint64)
        a, b = np.unique(every[:215]), np.unique(every[15:])     # 200 of 230: 87 %
        values = minmax.min_max([a, b])
        marks, keys = minmax.sketch(values), minmax.bands(values)
        shares.append((marks[0] == marks[1]).mean())
        misses += not (keys[0] == keys[1]).any()
    assert abs(np.mean(shares) - 200 / 230) < 0.01 and misses == 0
    assert min(shares) > minmax.agreement_needed(85)


def test_long_texts_are_hashed_in_pieces():
    text = (" ".join(f"word{i % 97}" for i in range(3000)) + " " + "y" * 5000 + "\t" + BASE + "\n" + "z" * 9000)
    t = next(T.slices(pa.array([text])))
    for limit in (1000, 4096, 1 << 20):
        hashes, first = T.word_hashes(t, lower=True, limit=limit)
        words = WORDS.findall(text)
        assert first.tolist() == [0, len(words)] == [0, len(hashes)]
        same = collections.defaultdict(set)
        for w, h in zip(words, hashes.tolist()):
            same[w].add(h)
        assert all(len(v) == 1 for v in same.values())
        assert len(set(hashes.tolist())) == len(set(words))
    short, _ = T.word_hashes(t, limit=1000)
    whole, _ = T.word_hashes(t)
    assert (short[:3000] == whole[:3000]).all()
    assert [s.tolist() for s in jaccard.shingle_sets(t, 5)] == [np.unique(T.combine(whole, 5)).tolist()]


# --- operator 13 -------------------------------------------------------------------


def collocations_brute(given, min_count, percent, top):
    """given: (lang, text)."""
    out = []
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in given:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cands.items()):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(map(repr, out))


def test_collocations(docs, empty, monkeypatch):
    given = [(lang, text) for _, text, lang, _, _ in rows()]
    for min_count, top, limits in ((2, 50, {}), (10, 2000, {}), (3, 2000, {"HELD": 20, "TOGETHER": 50, "PART_BITS": 2})):
        for name, value in limits.items():
            monkeypatch.setattr(collocations, name, value)
        got = collocations.collocations(docs, min_count=min_count, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(repr, map(tuple, got.collect()))) == collocations_brute(given, min_count, 50, top)
    assert collocations.op13_rows(empty).count() == 0


def phrases_of(run):
    """The phrases of a batch of runs with their counts."""
    out = collections.Counter()
    for r in run.to_pylist():
        phrases, n = r["phrases"].decode().split("\n"), np.frombuffer(r["n"], np.int64)
        assert len(phrases) == len(n) > 0
        for p, f in zip(phrases, n.tolist()):
            out[r["lang"], p] += f
    return out


def test_counts_do_not_depend_on_bursts_and_spills(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"é{k}" if k % 3 else "the," for k in rng.zipf(1.4, 200) % 300) for _ in range(120)]
    texts += [None, "", "a\tb\x0bc  d.e", ("x" * 3000 + " end. ") * 3]
    langs = ["en", "de"] * 62

    def counted(bits=None):
        total = collections.Counter()
        for start in range(0, 124, 31):
            batch = pa.RecordBatch.from_arrays([pa.array(langs[start:start + 31]), pa.array(texts[start:start + 31])],
                                               names=["lang", "text"])
            for b in collocations.count_phrases(bits)(iter([batch])):
                total.update(phrases_of(b))
        return total

    want = collections.Counter()
    for lang, text in zip(langs, texts):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                want.update((lang, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    assert counted() == want
    full = types.SimpleNamespace(value=np.full(collocations.FILTER_BITS // 8, 255, np.uint8))
    assert counted(full) == want
    for name, value in (("BURST", 4), ("HELD", 500), ("WORDS_HELD", 150), ("SLICE", 1 << 10)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(T, "SLICE_BYTES", 1 << 10)
    assert counted() == want


def test_pair_filter_lets_every_frequent_phrase_through(spark, monkeypatch):
    store.ship(spark)
    texts = [("en", "a b c."), ("en", "b c, a b"), ("de", "a b c"), ("en", "é \U0001f600 é \U0001f600"),
             ("und", ("x" * 5000 + " y ") * 2)]
    frame = spark.createDataFrame(texts, "lang string, text string")
    for held in (collocations.HELD, 1):
        monkeypatch.setattr(collocations, "HELD", held)
        bits = types.SimpleNamespace(value=collocations.pair_filter(frame, 2))
        batch = pa.RecordBatch.from_arrays(
            [pa.array(["en", "de", "und"]), pa.array(["a b c, b c d", "a b c", "x y z"])], names=["lang", "text"])
        got = {p for b in collocations.count_phrases(bits)(iter([batch])) for p in phrases_of(b)}
        assert {p for p in got if " " in p[1]} == {("en", "a b"), ("en", "b c"), ("en", "a b c")}
    assert not collocations.pair_filter(frame.where("false"), 2).any()


def test_scores_are_exact(spark):
    big = 3_000_000_007
    counts = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, 2 * big + 1), ("en", "b", 1, 3 * big + 2), ("en", "a b c", 3, 10),
         ("en", "c", 1, 40), ("en", "b c", 2, 12)], "lang string, phrase string, words int, f long")
    got = {r.phrase: (r.score, r.l, r.r) for r in collocations.scored(counts).collect()}
    assert got["a b"] == (10 ** 6 * big * big // ((2 * big + 1) * (3 * big + 2)), 2 * big + 1, 3 * big + 2)
    assert got["a b c"] == (0, 2 * big + 1, 12)                  # both cuts floor to 0: the first counts
    assert collocations.not_inside(collocations.scored(counts)).where(F.col("phrase") == "b c").count() == 0


# --- operator 10, names of columns ---------------------------------------------------


def test_segments_take_linear_time():
    """Hits far apart, each a candidate of its own, and slowly rising ones."""
    def seconds(n):
        score = np.full(100 * n, -0.05)
        score[::100] = np.linspace(1, 2, n)
        best = 9.0
        for _ in range(3):
            t0 = time.process_time()
            found = toxicity.maximal_segments(score)
            best = min(best, time.process_time() - t0)
        assert len(found) == n
        return best

    assert seconds(100_000) < 40 * seconds(10_000) + 0.5


def test_toxic_scores_equal_a_plain_count(spark):
    """Log-odds of whole forms and stems from a plain count of documents, then the
    segments by their definition."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["aha", "bee", "cow", "nasty" if i % 4 == 0 and i % 3 else "deer"] + [f"w{rng.integers(30)}" for _ in range(6)]),
             int(i % 4 == 0)) for i in range(80)]
    store.ship(spark)
    model = toxicity.lexicon(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    counts = {0: collections.Counter(), 1: collections.Counter()}
    for _, text, label in rows:
        forms = set(re.findall("[a-z]+", text))
        counts[label].update({(f, 0) for f in forms} | {(f[:n], n) for f in forms for n in toxicity.STEMS if len(f) >= n})
    share = sum(counts[1].values()) / (sum(counts[0].values()) + sum(counts[1].values()))

    def name(key):
        n1, n0 = counts[1][key], counts[0][key]
        odds = np.log((n1 / share + toxicity.PRIOR) / (n0 / (1 - share) + toxicity.PRIOR))
        ratio = 2 * sum(c * np.log(c / ((n0 + n1) * p)) for c, p in ((n1, share), (n0, 1 - share)) if c)
        return ratio, odds * ratio / (ratio + toxicity.FIRM ** 2)

    assert len(model.hash) == len({*counts[0], *counts[1]})
    t = next(T.slices(pa.array([rows[4][1] + " neverseen"])))
    scored = toxicity.scored_tokens(t, model)
    want = []
    for f in re.findall("[a-z]+", rows[4][1]):
        keys = [(f, 0)] + [(f[:n], n) for n in toxicity.STEMS if len(f) >= n]
        want.append(max((name(k) for k in keys), key=lambda x: x[0])[1])
    assert np.allclose(scored.score, [*want, -toxicity.DRIFT])
    assert (scored.score[:-1] != -toxicity.DRIFT).all() and scored.score[:-1].min() < 0 < scored.score.max()


def test_toxic_passages_of_a_long_text_are_found_in_pieces(monkeypatch):
    model = toxicity.Model(np.sort(T.span_hashes(np.frombuffer(b"scum", np.uint8), np.array([0]), np.array([4]))),
                           np.array([3.0]), np.array([9.0]))
    text = "clean words here, " * 300 + "scum scum é " + "more clean words. " * 300
    t = next(T.slices(pa.array([text])))
    whole = toxicity.scored_tokens(t, model)
    monkeypatch.setattr(T, "SLICE_BYTES", 64)
    parts = toxicity.scored_tokens(t, model)
    for a, b in ((whole.score, parts.score), (whole.start, parts.start), (whole.end, parts.end), (whole.first, parts.first)):
        assert (a == b).all()
    assert [x[2] for x in parts.segments()[0]] == [6.0]


def test_columns_named_like_internal_ones_are_kept(spark):
    names = ["_rest", "_t1", "_x", "_drop", "_d", "_k0", "_k1", "_k2", "_salt", "_hot", "other0", "th", "n"]
    store.ship(spark)
    frame = spark.createDataFrame([(i, "one two three\n" + "x " * i, *[f"{c}{i}" for c in names]) for i in (1, 2, 2, 9)],
                                  "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    for step in (lines.drop_repeated_lines, lines.drop_common_lines):
        out = step(frame, 2)
        assert set(frame.columns) <= set(out.columns)
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in names)
    kept = jaccard.keep_one(frame, 5, 80)
    assert kept.columns == frame.columns and all(r[c] == f"{c}{r.doc_id}" for r in kept.collect() for c in names)


def test_repeated_lines_are_found_by_runs_of_batches(spark, monkeypatch):
    """The line stage of the pipeline anti-joins every batch with the runs before it and
    adds its own run; where a line stays does not depend on the batches."""
    rows = [(i, "\n".join(["Common", f"own {i}", f"pair {i // 12}", ""])) for i in range(40)]
    rows += [(None, "common\nlast"), (7, rows[30][1]), (99, None), (50, "late"), (50, "common\nlate")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined, added = [], []
    unseen, put = lines.LineRuns.unseen, lines.LineRuns.put
    monkeypatch.setattr(lines.LineRuns, "unseen", lambda self, k: joined.append(sum(map(len, self.levels))) or unseen(self, k))
    monkeypatch.setattr(lines.LineRuns, "put", lambda self, r, level=0: added.append(level) or put(self, r, level))

    def key(line):
        return line.strip().lower()

    ids = {}
    for d, t in rows:
        if t is not None:
            ids[t] = min(ids.get(t, (True, 0)), (d is None, d or 0))
    holders = {}
    for t in ids:
        for k in {key(x) for x in t.split("\n")} - {""}:
            holders.setdefault(k, []).append((ids[t], t))
    expected = sorted(
        (d is None, d or 0, "\n".join(x for x in (t or "").split("\n")
                                      if len(h := holders.get(key(x), [])) < 10 or min(h)[1] == t)) for d, t in rows)
    for batches in (4, 3):
        got = lines.drop_repeated_lines(docs, 10, batches).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got) == expected
    assert joined == [0, 1, 2, 3, 0, 1, 2] and added.count(0) == 7 and 1 in added


def test_rank_model_and_threshold_use_every_labelled_row(spark):
    from stationflow.llm import hashed, quality_rank

    docs = spark.range(8000).selectExpr("id AS doc_id", "concat('word', id % 50, ' text') AS text")
    labels = spark.range(8000).selectExpr("id AS doc_id", "CAST(id % 50 > 20 AS INT) AS label")
    assert hashed.training_rows(docs, labels).count() == 8000
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 9000)
    margin = np.round(rng.normal(label, 1.0), 2)
    scored = spark.createDataFrame([(int(c), float(m)) for c, m in zip(label, margin)], "label int, margin double")
    weight = {0: 0.5, 1: 1.25}
    levels = np.quantile(margin, np.linspace(0, 1, quality_rank.LEVELS + 1))
    assert np.allclose(hashed.quantiles(scored, 9000, quality_rank.LEVELS), levels, rtol=0, atol=1e-12)
    each = np.where(label == 1, weight[1], weight[0])
    error = np.array([(each * ((margin >= q) != (label == 1))).sum() for q in levels])
    best = np.flatnonzero(error <= error.min() + 1e-9)
    assert quality_rank.quantile_threshold(scored, 9000, weight) == levels[best[len(best) // 2]]
    assert np.allclose(hashed.platt_table(scored, weight), hashed.platt(margin, label, each), rtol=1e-6)
