"""Operator 13: phrase collocation mining by HAT-trie counting.

1. A task finds the words of its texts, slice by slice, as ids of its own, and counts
   phrases in a HAT-trie per language: a shallow trie over word ids whose leaves are
   hash containers. A container holds the phrases of a range of word ids; when it
   grows over ``BURST`` entries it bursts into two by the median id, and at a single
   id by the ids of the next word.
2. When a task holds ``HELD`` entries, it spills whole subtrees, the largest first,
   as sorted runs, until half are left. Word ids end there: runs hold texts.
3. The runs are merged per prefix partition: a phrase belongs to the partition that a
   hash of its first two words gives (longer phrases to one of ``SPLIT`` partitions for
   these words, so that a very frequent prefix is many tasks). A run is a row for each
   partition, with its phrases and counts; a task goes through its partitions in
   order and holds the distinct phrases of one.
4. Before that, one pass counts 48-bit hashes of all pairs of words. A phrase is
   frequent only if all its pairs are; a bit for each frequent hash, ``FILTER_BITS``
   bits at any size of the input, tells the trie which phrases cannot be. A fuller
   filter only lets more phrases through to be counted.
5. Candidates (two words and more, often enough) meet the counts of the two sides of
   each of their cuts, and the counts of longer candidates that hold them. All
   arithmetic is on integers and decimals of 38 digits.
6. The first ``TOP`` of each language are taken in two steps, first within parts.

Defined results: a null or empty text has no word; a null language is ``und``; texts
of any length are counted whole (one batch of them is in memory at a time, its words
in slices); repeated rows count as often as they occur; ties end with the phrase in
UTF-8 order; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import collections
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.store import saved, tidy

MAX_WORDS = 3
MIN_COUNT = 10
INSIDE_PERCENT = 50
TOP = 2000
SCALE = 1_000_000

# Entries of a container before it bursts, entries and words of a task before it spills.
BURST = 1 << 17
HELD = 1_500_000
ID_BITS = 63 // MAX_WORDS
WORDS_HELD = 500_000
WORD_BYTES_HELD = 32 << 20
SLICE = 2 << 20
FILTER_BITS = 1 << 28
# Prefix partitions of a language, as bits; the same at every size, so that a run has
# as many rows at most.
PART_BITS = 12
TOGETHER = 1 << 18
SPLIT = 64
# Parts of the first step of a top list.
TOP_PARTS = 16
# Copies of the count of a single word.
COPIES = 8

# What ends a piece (and a word), and what ends a word only.
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:!?"] + [*range(0x0A, 0x0E)]] = True
_GAP = _END.copy()
_GAP[[0x20, 0x09]] = True


_SCATTER = np.uint64(0x9E3779B97F4A7C15)


class Container:
    """Counts of packed keys (``MAX_WORDS`` ids of ``ID_BITS`` bits, 0 behind the last
    word) from ``low`` on, in a hash table with open addressing that takes many
    distinct keys at once."""

    __slots__ = ("keys", "low", "n", "size")

    def __init__(self, low: int, expected: int = 512):
        self.low, self.size = low, 0
        slots = 1 << (2 * expected - 1).bit_length()
        self.keys, self.n = np.zeros(slots, np.int64), np.zeros(slots, np.int64)

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        if 2 * (self.size + len(keys)) > len(self.keys):
            held, counts = self.sorted()
            self.__init__(self.low, len(held) + len(keys))
            self._put(held, counts)
        self._put(keys, n)

    def _put(self, keys: np.ndarray, n: np.ndarray) -> None:
        mask = len(self.keys) - 1
        shift = np.uint64(64 - mask.bit_length())
        slot = (keys.astype(np.uint64) * _SCATTER >> shift).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]          # of several keys for a slot the last one has it
            mine = self.keys[slot] == keys
            self.n[slot[mine]] += n[mine]
            self.size += int((free & mine).sum())
            left = ~mine
            keys, n, slot = keys[left], n[left], (slot[left] + 1) & mask

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(self.keys)
        own = own[np.argsort(self.keys[own])]
        return self.keys[own], self.n[own]

    def burst(self) -> list["Container"]:
        """Two containers, cut at the middle entry: between first words, or within
        one first word between second words, and so on."""
        keys, n = self.sorted()
        for level in range(MAX_WORDS - 1, -1, -1):
            shift = ID_BITS * level
            bound = int(keys[len(keys) // 2]) >> shift << shift
            if bound <= keys[0]:                        # the half is one word: cut behind it
                bound += 1 << shift
            cut = int(np.searchsorted(keys, bound))
            if 0 < cut < len(keys):
                break
        out = []
        for low, a, b in ((self.low, 0, cut), (bound, cut, len(keys))):
            out.append(Container(low, b - a))
            out[-1].add(keys[a:b], n[a:b])
        return out


class Trie:
    """The containers of a language, in the order of the ids they begin with."""

    def __init__(self):
        self.leaves = [Container(0)]

    @property
    def entries(self) -> int:
        return sum(c.size for c in self.leaves)

    def add(self, keys: np.ndarray) -> None:
        distinct, n = np.unique(keys, return_counts=True)
        edge = [0, *np.searchsorted(distinct, [c.low for c in self.leaves[1:]]).tolist(), len(distinct)]
        for leaf, a, b in zip(list(self.leaves), edge[:-1], edge[1:]):
            if b > a:
                leaf.add(distinct[a:b], n[a:b])
                if leaf.size > BURST:
                    at = self.leaves.index(leaf)
                    self.leaves[at:at + 1] = leaf.burst()


class Counter:
    """The tries of a task, one per language, and the ids of its words."""

    def __init__(self, part_bits: int):
        self.part_bits = part_bits
        self.tries: dict[str, Trie] = {}
        self.ids: dict[bytes, int] = {}
        self.hashes: list[np.ndarray] = []          # of the words, in the order of their ids
        self.word_bytes = 0

    @property
    def entries(self) -> int:
        return sum(t.entries for t in self.tries.values())

    def word_ids(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Ids from 1 on; 0 stands behind the last word of a phrase."""
        out, known = np.empty(len(words), np.int64), len(self.ids)
        for i, w in enumerate(words):
            found = self.ids.get(w)
            if found is None:
                found = self.ids[w] = len(self.ids) + 1
                self.word_bytes += len(w)
            out[i] = found
        self.hashes.append(hashes[out > known])
        return out

    def full(self) -> bool:
        return len(self.ids) > WORDS_HELD or self.word_bytes > WORD_BYTES_HELD

    def _run(self, lang: str, keys: np.ndarray, n: np.ndarray, names: pa.Array) -> Iterator[pa.RecordBatch]:
        """A sorted run: a row for each prefix partition."""
        if not len(keys):
            return
        mask = (1 << ID_BITS) - 1
        ids = [(keys >> (ID_BITS * (MAX_WORDS - 1 - i))) & mask for i in range(MAX_WORDS)]
        hashes = np.concatenate([np.zeros(1, np.uint64), *self.hashes])
        at = hashes[ids[0]] * np.uint64(3) + hashes[ids[1]]
        for x in ids[2:]:
            at = at * np.uint64(5) + hashes[x] % np.uint64(SPLIT)
        part = (T.mix(at) >> np.uint64(64 - self.part_bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        words = [names.take(pa.array(np.maximum(x[order] - 1, 0), mask=x[order] == 0)) for x in ids]
        phrase = pc.binary_join_element_wise(*words, b" ", null_handling="skip")
        edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), phrase), b"\n")
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(edge) - 1), pa.string()), pa.array(part[edge[:-1]]), text, _packed(n[order], edge)],
            names=["lang", "part", "phrases", "n"])

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Give whole subtrees, the largest first, until ``keep`` entries are left;
        with none left the word ids start anew."""
        names = pa.array(list(self.ids), pa.binary())
        left = self.entries
        trees = [(c.size, lang, c.low) for lang, t in self.tries.items() for c in t.leaves if c.size]
        for size, lang, low in sorted(trees, reverse=True):
            if left <= keep:
                break
            leaves = self.tries[lang].leaves
            at = next(i for i, c in enumerate(leaves) if c.low == low)
            yield from self._run(lang, *leaves[at].sorted(), names)
            leaves[at] = Container(low)
            left -= size
        if not left:
            self.tries, self.ids, self.hashes, self.word_bytes = {}, {}, [], 0


def _packed(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Runs of an array as binary values."""
    offsets = (edge * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _spans(t: T.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of a run of rows, and a number of its piece."""
    inside = ~_GAP[t.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[t.offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    piece = np.cumsum(_END[t.data], dtype=np.int64)
    row = np.searchsorted(t.offsets, start, "right")
    return start, end, piece[start] + row * (np.int64(len(t.data)) + 1) if len(start) else start


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of every word; very long ones, which would stretch the slice, by a
    digest of their own."""
    long = end - start >= T.SLICE_BYTES
    if not long.any():
        return T.span_hashes(data, start, end)
    out = np.empty(len(start), np.uint64)
    for i in np.flatnonzero(long).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    short = np.flatnonzero(~long)
    if len(short):
        size = end[short] - start[short]
        first = np.cumsum(size) - size
        at = np.repeat(start[short] - first, size) + np.arange(size.sum())
        out[short] = T.span_hashes(data[at], first, first + size)
    return out


def _distinct_words(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                    hashes: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """For every word the number of its form, the forms and their hashes. Forms are told apart by
    64 bits of hash within a slice."""
    codes, distinct = pd.factorize(hashes)
    place = np.zeros(len(distinct), np.int64)
    place[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, [data[a:b].tobytes() for a, b in zip(start[place].tolist(), end[place].tolist())], distinct


def _cut(t: T.Texts) -> Iterator[T.Texts]:
    """A run that is one long text, in parts that end behind the end of a piece."""
    if t.rows != 1 or len(t.data) <= SLICE:
        yield t
        return
    a, n = 0, len(t.data)
    while a < n:
        b = min(n, a + SLICE)
        while b < n:
            ends = np.flatnonzero(_END[t.data[b:b + SLICE]])
            if len(ends):
                b += int(ends[0]) + 1
                break
            b = min(n, b + SLICE)
        yield T.Texts(t.first, t.data[a:b], np.array([0, b - a]))
        a = b


def pair_hashes(lang: str, hashes: np.ndarray) -> np.ndarray:
    """48 bits for every two consecutive words, below a bit that is always set."""
    salt = np.uint64(zlib.crc32(lang.encode()) * 2 + 1)
    return (T.combine(hashes ^ salt, 2) >> np.uint64(16) | np.uint64(1 << 48)).astype(np.int64)


def _phrase_keys(ids: np.ndarray, piece: np.ndarray, may: np.ndarray | None) -> np.ndarray:
    """Packed ids of all phrases within a piece; ``may`` says of each pair of words if
    it may be frequent."""
    out = []
    for k in range(1, MAX_WORDS + 1):
        m = len(ids) - k + 1
        if m <= 0:
            break
        own = piece[:m] == piece[k - 1:]
        for i in range(k - 1) if may is not None else ():
            own &= may[i:i + m]
        key = np.zeros(int(own.sum()), np.int64)
        for i in range(k):
            key |= ids[i:i + m][own] << (ID_BITS * (MAX_WORDS - 1 - i))
        out.append(key)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _words_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """lang, data, start and end of each word, its hash and the number of its piece,
    a slice at a time."""
    langs, codes = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    for i, lang in enumerate(langs.tolist()):
        for whole in T.slices(batch.column("text").take(pa.array(np.flatnonzero(codes == i))), SLICE):
            for t in _cut(whole):
                data = T.LOWER[t.data]
                start, end, piece = _spans(T.Texts(0, data, t.offsets))
                if len(start):
                    yield lang, data, start, end, _word_hashes(data, start, end), piece


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of lang and text; out come the counts of pairs by hash, a row for each
    16 bits of hash with the other 32 bits and the counts (65535: or more) of all."""

    def given(held: Container) -> Iterator[pa.RecordBatch]:
        keys, n = held.sorted()
        segment = keys >> 32
        edge = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment[edge[:-1]]), _packed(keys.astype(np.uint32), edge),
                 _packed(np.minimum(n, 65535).astype(np.uint16), edge)], names=["segment", "low", "n"])

    held = Container(0)
    for batch in batches:
        for lang, _, _, _, hashes, piece in _words_of(batch):
            held.add(*np.unique(pair_hashes(lang, hashes)[piece[1:] == piece[:-1]], return_counts=True))
            if held.size > HELD:
                yield from given(held)
                held = Container(0)
    yield from given(held)


def often(min_count: int):
    """From rows of ``count_pairs`` in the order of their segments to the bits of pairs
    found ``min_count`` times. Holds the distinct hashes of one segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, low, n, added, found = None, [], [], 0, []

        def together() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate(low), return_inverse=True)
            return keys, np.bincount(back, np.concatenate(n), len(keys))

        def bits() -> None:
            keys, total = together()
            keys = keys[total >= min(min_count, 65535)].astype(np.int64) | np.int64(at) << 32
            if len(keys):
                found.append(keys & (FILTER_BITS - 1))

        for batch in batches:
            for segment, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "low", "n"))):
                if segment != at:
                    if low:
                        bits()
                    at, low, n, added = segment, [], [], 0
                low.append(np.frombuffer(a, np.uint32))
                n.append(np.frombuffer(b, np.uint16))
                added += len(low[-1])
                if added > max(HELD, len(low[0])):
                    keys, total = together()
                    low, n, added = [keys], [total], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["bit"])
                found.clear()
        if low:
            bits()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["bit"])

    return run


def count_phrases(bits=None, part_bits: int = PART_BITS):
    """A step from batches of lang and text to sorted runs of phrases with their
    counts, in ``2 ** part_bits`` prefix partitions; ``bits`` is a broadcast filter of
    pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(part_bits)
        for batch in batches:
            for lang, data, start, end, hashes, piece in _words_of(batch):
                may = None
                if bits is not None and len(hashes) > 1:
                    at = pair_hashes(lang, hashes) & (FILTER_BITS - 1)
                    may = (bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                word, forms, own = _distinct_words(data, start, end, hashes)
                if len(counter.ids) + len(forms) >= 1 << ID_BITS:
                    yield from counter.spill(0)
                keys = _phrase_keys(counter.word_ids(forms, own)[word], piece, may)
                if lang not in counter.tries:
                    counter.tries[lang] = Trie()
                counter.tries[lang].add(keys)
                if counter.full():
                    yield from counter.spill(0)
                elif counter.entries > HELD:
                    yield from counter.spill(HELD // 2)
        yield from counter.spill(0)

    return run


def pair_filter(rows: DataFrame, min_count: int) -> np.ndarray:
    """``FILTER_BITS`` bits, set for the pairs of words found ``min_count`` times."""
    counted = rows.mapInArrow(tidy(count_pairs), "segment long, low binary, n binary")
    bits = counted.repartition("segment").sortWithinPartitions("segment").mapInArrow(tidy(often(min_count)), "bit long")
    bit = F.col("bit") + 1                          # Spark's buckets begin at 1
    # Bitmaps of 4 KB, as many as the filter has at most.
    maps = (bits.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("map"))).toArrow()
    out = np.zeros(max(FILTER_BITS // 8, 4096), np.uint8)
    for bucket, bitmap in zip(maps.column("bucket").to_pylist(), maps.column("map").to_pylist()):
        at = (bucket - 1) * len(bitmap)
        out[at:at + len(bitmap)] = np.frombuffer(bitmap, np.uint8)
    return out


def merged(min_count: int):
    """From rows of runs, in the order of language and partition, to the counts of all
    phrases found ``min_count`` times, and of all other words in one sum (a null
    phrase). Takes whole partitions together, ``TOGETHER`` phrases or the distinct
    phrases of one partition at most."""

    def together(rows: list[tuple]) -> tuple[pa.Table, list[str]]:
        """Phrases, each once per language (by its number), and their counts."""
        langs = sorted({r[0] for r in rows})
        number = {lang: i for i, lang in enumerate(langs)}
        n = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
        own = np.repeat([number[r[0]] for r in rows], [len(r[3]) // 8 for r in rows])
        t = pa.table({"lang": own, "phrase": pa.array(b"\n".join(r[2] for r in rows).split(b"\n"), pa.binary()), "f": n})
        return t.group_by(["lang", "phrase"]).aggregate([("f", "sum")]), langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare: collections.Counter = collections.Counter()

        def counts(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            t, langs = together(rows)
            often = pc.greater_equal(t.column("f_sum"), min_count)
            single = pc.equal(pc.count_substring(t.column("phrase"), b" "), 0)
            rest = t.filter(pc.and_(pc.invert(often), single))
            for i, f in zip(rest.column("lang").to_pylist(), rest.column("f_sum").to_pylist()):
                rare[langs[i]] += f
            some = t.filter(often)
            yield from pa.table({"lang": pa.array(langs, pa.string()).take(some.column("lang").combine_chunks()),
                                 "phrase": some.column("phrase").cast(pa.string()), "f": some.column("f_sum")}).to_batches()

        done, last, added = [], [], 0               # rows of whole partitions, rows of the last one
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "phrases", "n"))):
                if last and row[:2] != last[0][:2]:
                    done += last
                    last = []
                    if added > TOGETHER:
                        yield from counts(done)
                        done, added = [], 0
                last.append(row)
                added += len(row[3]) // 8
                if len(last) > 1 and added > 2 * max(HELD, len(last[0][3]) // 8):
                    if done:
                        yield from counts(done)
                        done = []
                    t, _ = together(last)
                    last = [(*row[:2], b"\n".join(t.column("phrase").to_pylist()),
                             t.column("f_sum").to_numpy().astype(np.int64).tobytes())]
                    added = t.num_rows
        if done or last:
            yield from counts(done + last)
        if rare:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rare), pa.string()), pa.nulls(len(rare), pa.string()),
                 pa.array(list(rare.values()), pa.int64())], names=["lang", "phrase", "f"])

    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of the phrases found ``min_count`` times or more, and
    (lang, n): how many words a language has."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text")).where("length(text) > 0")
    bits = docs.sparkSession.sparkContext.broadcast(pair_filter(rows, min_count))
    runs = rows.mapInArrow(tidy(count_phrases(bits, PART_BITS)), "lang string, part long, phrases binary, n binary")
    counts = (runs.repartition("lang", "part").sortWithinPartitions("lang", "part")
              .mapInArrow(tidy(merged(min_count)), "lang string, phrase string, f long"))
    words = F.length("phrase") - F.length(F.replace(F.col("phrase"), F.lit(" "), F.lit(""))) + 1
    kept = saved(counts.withColumn("words", words), "phrase_counts")
    return (kept.where("phrase IS NOT NULL").select("lang", "phrase", "words", "f"),
            kept.where("coalesce(words, 1) = 1").groupBy("lang").agg(F.sum("f").alias("n")))


def _side(parts: DataFrame, counts: DataFrame, text: Column, name: str) -> DataFrame:
    """``parts`` with the count of the phrase ``text`` as ``name``. Single words are in
    very many phrases: their counts are repeated and the phrases dealt."""
    spread = F.when(F.instr(text, " ") > 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("phrase"), F.lit(COPIES)).cast("int"))
    copies = F.when(F.col("words") > 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    known = counts.select(F.col("lang").alias("own"), F.col("phrase").alias("part"), F.col("f").alias(name),
                          F.explode(copies).alias("salt"))
    return parts.join(known, (F.col("lang") == F.col("own")) & (text == F.col("part")) & (spread == F.col("salt"))) \
        .drop("own", "part", "salt")


def scored(counts: DataFrame, min_words: int = 2) -> DataFrame:
    """lang, phrase, words, a, l, r and score of every candidate, by its worst cut."""
    cands = counts.where(F.col("words") >= min_words).select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = cands.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    head, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - words)")
    both = _side(_side(cuts, counts, head, "l"), counts, rest, "r")
    # Counts below 10 ** 15, so that both sides have 38 digits at most.
    a, l, r = (f"CAST({c} AS DECIMAL(15,0))" for c in "alr")
    value = F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * CAST({a} * {a} AS DECIMAL(30,0))) div ({l} * {r})")
    return (both.withColumn("score", value).groupBy("lang", "phrase", "words", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
            .select("lang", "phrase", "words", "a", "x.l", "x.r", "x.score"))


def not_inside(found: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """Without candidates that lie in a longer one with ``percent`` of their count."""
    tokens = F.split("phrase", " ")
    # Starts and lengths of the shorter phrases of two words and more inside.
    places = F.expr("""flatten(transform(sequence(2, words - 1), n ->
        transform(sequence(1, words - n + 1), i -> struct(i AS i, n AS n))))""")
    inner = (found.where("words > 2").select("lang", "a", tokens.alias("tokens"), F.explode(places).alias("p"))
             .select("lang", F.concat_ws(" ", F.slice("tokens", F.col("p.i"), F.col("p.n"))).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return (found.join(inner, ["lang", "phrase"], "left")
            .where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a"), F.lit(True))).drop("longer"))


def first_of_each(found: DataFrame, top: int = TOP) -> DataFrame:
    """``rank`` of the first ``top`` of each language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    some = (found.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top).drop("part"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, percent: int = INSIDE_PERCENT,
                 top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first phrases."""
    counts, totals = phrase_counts(docs, min_count)
    best = first_of_each(not_inside(saved(scored(counts), "phrase_scores"), percent), top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_rows(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))
