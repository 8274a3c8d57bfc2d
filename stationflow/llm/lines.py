"""Operator 5: line deduplication with levelled sorted runs (native Spark only).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased; it is known by two 64-bit hashes. ``LineRuns`` keeps runs of
(h1, h2, n_docs) sorted by hash, in levels. Every batch of documents adds a run
to level 0; when a level has ``fan_in`` runs they are merged into one run of the
next level, so a batch is rewritten only a logarithmic number of times. Runs are
merged by hash aggregation.

``drop_seen_lines`` takes documents batch by batch: the distinct keys of a batch
are merge-anti-joined with the runs, a key no run holds stays where it is first
held, and the batch adds its own run. The rule of ``drop_common_lines`` needs the
count over all documents, so there no batch is joined with earlier runs: once all
are added, every line is joined with the total, and those whose key enough
documents hold go.

Skew: counting combines map-side. In the join, keys held by a large share
of all lines are few by a counting bound (see ``FREQUENT``) and are sent to
every task; all other keys are joined by a shuffle in which no key is hot.

Defined results: a null or empty text is one empty line; the key of a blank
line is empty and never counts; a repeated row is a document of its own; rows
that share doc_id and text get equal answers; a null doc_id is kept; an empty
table gives no row; extra columns are kept by ``drop_common_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.store import saved, with_plain_names

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Batches in which the documents of one call are added to the runs.
BATCHES = 4
FAN_IN = 4
# A key is frequent if it holds more than one in this many of all (line,
# document) pairs; there are at most so many of them.
FREQUENT = 50_000


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column) -> Column:
    """(h1, h2) of the key of each line; null for an empty key. Every step is a
    pass of its own, so that no lambda works out its argument more than once."""
    stripped = F.transform(line_array(text), lambda x: F.btrim(x, F.lit(SPACE)))
    # Only A-Z change, also beside other letters.
    keys = F.transform(stripped, lambda x: F.when(F.length(x) == F.octet_length(x), F.lower(x))
                       .otherwise(F.translate(x, UPPER, LOWER)))
    return F.transform(keys, lambda k: F.when(F.length(k) >= 1, F.struct(
        F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("second"), k).alias("h2"))))


def without_lines(text: Column, drop: Column) -> Column:
    """(n, text): the number of lines and the text without the lines at ``drop``.
    The lines are bound once, as the element of a one-element array: named inside
    a lambda, the split would run again for every line."""
    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    bound = F.transform(F.array(line_array(text)), lambda lines: F.struct(
        F.size(lines).alias("n"),
        F.when(drop.isNull(), F.coalesce(text, F.lit(""))).otherwise(rest(lines)).alias("text")))
    return F.get(bound, F.lit(0))


class LineRuns:
    """Counts of documents by line key, in levelled sorted runs."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def run(counts: DataFrame, level: int = 0) -> DataFrame:
        """A sorted run, written: rows (h1, h2, n), one per key, and maybe other columns."""
        return saved(counts.sortWithinPartitions("h1", "h2"), f"line_run_{level}")

    def add(self, counts: DataFrame) -> None:
        """Add a batch: rows (h1, h2, n), one per key."""
        self.put(self.run(counts))

    def put(self, run: DataFrame, level: int = 0) -> None:
        """Add a written run to a level."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self.put(self.run(merged, level + 1), level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.unionByName, [r.select("h1", "h2", "n") for r in runs])
        return every.groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame | None:
        """All keys with their counts over all batches added so far."""
        runs = [r for level in self.levels for r in level]
        return self._merged(runs) if len(runs) > 1 else runs[0] if runs else None

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys``, one per (h1, h2), whose key no run holds. The rows are
        shuffled and sorted once, by the first join, for the joins with all runs."""
        for level in self.levels:
            for run in level:
                keys = keys.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return keys

    def common(self, min_docs: int) -> DataFrame | None:
        counts = self.counts()
        return None if counts is None else counts.where(F.col("n") >= min_docs)


def common_places(docs: DataFrame, min_docs: int, batches: int = BATCHES) -> DataFrame:
    """(doc_id, t, drop): the places of the lines to drop, for rows that have any."""
    spark = docs.sparkSession
    keys = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"),
                    line_hashes(F.col("text")).alias("lines"),
                    F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch")),
        "line_keys", partition_by="batch")
    runs = LineRuns(spark)
    for b in range(batches):
        # Distinct keys of a row are found within the row, before any shuffle.
        distinct = F.array_distinct(F.filter("lines", lambda x: x.isNotNull()))
        runs.add(keys.where(F.col("batch") == b).select(F.explode(distinct).alias("k"))
                 .groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n")))
    return drops(keys, runs, min_docs)


def drops(keys: DataFrame, runs: LineRuns, min_docs: int) -> DataFrame:
    """Join the lines of rows with the common keys of all runs."""
    common = saved(runs.common(min_docs), "common_lines")
    pairs = common.agg(F.sum("n")).first()[0] or 0
    limit = max(min_docs, pairs // FREQUENT + 1)
    frequent = common.where(F.col("n") >= limit).select("h1", "h2", F.lit(True).alias("frequent"))
    other = common.where(F.col("n") < limit).select("h1", "h2")
    placed = (keys.select("doc_id", "t", F.posexplode("lines").alias("pos", "k"))
              .where("k IS NOT NULL").select("doc_id", "t", "pos", "k.h1", "k.h2")
              .join(F.broadcast(frequent), ["h1", "h2"], "left"))
    found = (placed.where("frequent").select("doc_id", "t", "pos")
             .unionByName(placed.where("frequent IS NULL")
                          .join(other, ["h1", "h2"], "left_semi").select("doc_id", "t", "pos")))
    return found.groupBy("doc_id", "t").agg(F.collect_set("pos").alias("drop"))


@with_plain_names
def drop_common_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """All columns of ``docs`` with the common lines gone from ``text``, and
    ``_n_lines`` (before), ``_n_dropped``."""
    places = common_places(docs, min_docs).select(
        F.col("doc_id").alias("_d"), F.col("t").alias("_t"), F.col("drop").alias("_drop"))
    joined = docs.withColumn("_x", F.xxhash64("text")).join(
        places, F.expr("_x = _t AND CAST(doc_id AS BIGINT) <=> _d"), "left")
    joined = joined.withColumn("_rest", without_lines(F.col("text"), F.col("_drop")))
    return joined.select(
        *(F.col("_rest.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.col("_rest.n").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("_n_dropped"))


def ranges(docs: DataFrame, batches: int) -> Column:
    """The batch of a struct ``d`` (x: no id, id): ranges of doc_id in ascending order,
    about equal in rows; null ids are in the last."""
    cuts = docs.select(F.col("doc_id").cast("long").alias("id")).approxQuantile(
        "id", [i / batches for i in range(1, batches)], 0.01)
    past = F.lit(0)
    for c in cuts:
        past = past + F.when(F.col("d.id") > int(c), 1).otherwise(0)
    return F.when(F.col("d.x"), F.lit(batches - 1)).otherwise(past)


@with_plain_names
def drop_repeated_lines(docs: DataFrame, min_docs: int, batches: int = BATCHES) -> DataFrame:
    """All columns of ``docs``; of lines whose key ``min_docs`` distinct texts hold,
    those of the first text that holds it stay (by its smallest doc_id, null ids
    last, then by hash), the others go. Rows of one text count once and get equal
    answers, so copies stay whole or lose the same lines, and no line is lost in
    every text.

    Texts come in batches, in the order of their ids. A batch's keys are
    merge-anti-joined with the runs: those that no run holds have their first text
    in this batch. Then the batch adds its own run, and the runs give the counts."""
    spark = docs.sparkSession
    ids = {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), "text")}
    doc_id = F.col("doc_id").cast("long")
    texts = saved(
        docs.select(*(v.alias(k) for k, v in ids.items()),
                    F.struct(doc_id.isNull().alias("x"), doc_id.alias("id")).alias("d"),
                    line_hashes(F.col("text")).alias("lines"))
        .groupBy("t1", "t2").agg(F.min("d").alias("d"), F.first("lines").alias("lines"))
        .withColumn("batch", ranges(docs, batches)), "line_texts")
    distinct = F.array_distinct(F.filter("lines", lambda x: x.isNotNull()))
    runs, first = LineRuns(spark), []
    for b in range(batches):
        own = runs.run(
            texts.where(F.col("batch") == b)
            .select(F.struct("d.x", "d.id", "t1", "t2").alias("t"), F.explode(distinct).alias("k"))
            .groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("f")))
        first.append(runs.unseen(own).select("h1", "h2", F.col("f.t1").alias("f1"), F.col("f.t2").alias("f2")))
        runs.put(own)
    common = saved(runs.common(min_docs).join(reduce(DataFrame.unionByName, first), ["h1", "h2"]), "first_lines")
    pairs = common.agg(F.sum("n")).first()[0] or 0
    limit = max(min_docs, pairs // FREQUENT + 1)
    frequent, other = common.where(F.col("n") >= limit).drop("n"), common.where(F.col("n") < limit).drop("n")
    placed = (texts.select("t1", "t2", F.posexplode("lines").alias("pos", "k"))
              .where("k IS NOT NULL").select("t1", "t2", "pos", "k.h1", "k.h2")
              .join(F.broadcast(frequent), ["h1", "h2"], "left"))
    found = (placed.where("f1 IS NOT NULL")
             .unionByName(placed.where("f1 IS NULL").drop("f1", "f2").join(other, ["h1", "h2"]))
             .where("t1 <> f1 OR t2 <> f2"))
    # Written, so that both sides of the join below come straight from a shuffle
    # and Spark can split a text with many copies.
    places = saved(found.groupBy("t1", "t2").agg(F.collect_set("pos").alias("_drop"))
                   .select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "_drop"), "line_places")
    joined = (docs.withColumns({f"_{k}": v for k, v in ids.items()}).join(places, ["_t1", "_t2"], "left")
              .withColumn("_rest", without_lines(F.col("text"), F.col("_drop"))))
    return joined.select(*(F.col("_rest.text").alias("text") if c == "text" else F.col(f"`{c}`")
                           for c in docs.columns))


@with_plain_names
def drop_seen_lines(docs: DataFrame, runs: LineRuns) -> DataFrame:
    """All columns of a batch ``docs``, its text without lines whose key an earlier
    batch of ``runs`` holds or an earlier place of this batch (by smallest doc_id,
    null ids last, then by hash of the text, then by place), and ``_n_lines``
    (before), ``_n_dropped``. The batch's keys are added to ``runs``. Blank lines
    stay; rows that share doc_id and text are one document and get equal answers.

    Keys are brought together map-side before they are shuffled, and answers go
    back by document, so a line that very many documents hold is hot nowhere."""
    doc_id = F.col("doc_id").cast("long")
    here = F.struct(doc_id.isNull().alias("x"), doc_id.alias("id"), F.xxhash64("text").alias("t"),
                    F.col("pos").alias("pos"))
    keys = saved(
        docs.select("doc_id", "text", F.posexplode(line_hashes(F.col("text"))).alias("pos", "k"))
        .where("k IS NOT NULL").select("k.h1", "k.h2", here.alias("f"))
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("f").alias("f")), "batch_lines")
    first = saved(runs.unseen(keys).groupBy(F.col("f.id").alias("_d"), F.col("f.t").alias("_t"))
                  .agg(F.collect_set("f.pos").alias("_keep")), "first_places")
    runs.add(keys.select("h1", "h2", "n"))
    joined = docs.withColumn("_x", F.xxhash64("text")).join(
        first, F.expr("_x = _t AND CAST(doc_id AS BIGINT) <=> _d"), "left")
    hashes = line_hashes(F.col("text"))
    keyed = F.filter(F.transform(hashes, lambda k, i: F.when(k.isNotNull(), i)), lambda i: i.isNotNull())
    gone = F.array_except(keyed, F.coalesce("_keep", F.array().cast("array<int>")))
    joined = joined.withColumn("_drop", gone).withColumn("_rest", without_lines(F.col("text"), F.col("_drop")))
    return joined.select(
        *(F.col("_rest.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.col("_rest.n").cast("long").alias("_n_lines"), F.size("_drop").cast("long").alias("_n_dropped"))


def op5_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    out = drop_common_lines(docs.select("doc_id", "text"), min_docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
