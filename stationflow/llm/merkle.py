"""Operator 11: Merkle manifest of a dataset as a persistent path-copying tree.

1. Every row becomes a leaf: sha256 over its fields, each ``-`` if null, else its
   UTF-8 byte count, ``:`` and its value.
2. The leaves of a group (a source) get consecutive places: the rows are dealt by
   ranges of (group, key, leaf), and each range adds what the ranges before it
   hold of the group. So a group of any size is many tasks.
3. The tree of a group is built in aligned blocks of ``FAN_OUT ** LEVELS`` leaves.
   A task builds the nodes of a block once. A tampered leaf makes a version that
   shares them all but the copies of its own ancestors.
4. The tops of the blocks are the nodes of the next round, until each group has
   one node; the tops of the groups, in their order, are the leaves of the tree
   above. Going back down, every block gets the path of its top to the root once,
   and its leaves and versions go on along that path, each in its own row.

A row's ``path`` lists, level by level up to the root, the digests left and right
of it in its run; the proof is their concatenation.

Defined results: a null group is a group of its own and comes first; a null key
comes first in its group; rows that share a key are ordered by their leaf (equal
leaves are interchangeable); a null or empty text is a field like any other; a
text of any length is hashed whole, in the JVM; an empty table gives no row;
columns that are no field are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.store import saved, tidy

FAN_OUT = 3
# Levels of a block: 729 leaves.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*map(framed, fields)), 256)


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def block_tree(leaves: Sequence[str], levels: int | None) -> list[list[str]]:
    """The nodes over ``leaves``, level by level: ``levels`` levels, or up to one
    node (None)."""
    tree = [list(leaves)]
    while len(tree) <= levels if levels is not None else len(tree[-1]) > 1:
        below = tree[-1]
        tree.append([_hash(below[i:i + FAN_OUT]) for i in range(0, len(below), FAN_OUT)])
    return tree


def path_of(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a leaf in its run, level by level."""
    out = []
    for nodes in tree[:-1]:
        run = at - at % FAN_OUT
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + FAN_OUT])))
        at //= FAN_OUT
    return out


def copied_path(tree: list[list[str]], at: int, digest: str) -> list[str]:
    """A version of the tree in which leaf ``at`` is ``digest``: the copies of the
    leaf and of its ancestors. All other nodes are those of ``tree``."""
    out = [digest]
    for nodes in tree[:-1]:
        run, inside = at - at % FAN_OUT, at % FAN_OUT
        family = nodes[run:run + FAN_OUT]
        family[inside] = out[-1]
        out.append(_hash(family))
        at //= FAN_OUT
    return out


def folded(digest: Column, path: Column) -> Column:
    """The digest at the end of a path."""
    return F.aggregate(path, digest, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def copies_along(first: Column, path: Column) -> Column:
    """The copies of ancestors along a path, after the last of ``first``."""
    return F.aggregate(path, first, lambda have, x: F.array_append(
        have, F.sha2(F.concat(x["left"], F.element_at(have, -1), x["right"]), 256)))


def ranked(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place ``at`` (from 0) in their group ``grp`` by ``keys``,
    and the ``size`` of the group."""
    order = ["grp", *keys]
    dealt = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("mid", F.monotonically_increasing_id()), name)
    # Written with its range's number above the 33rd bit and its place in it below.
    part = F.shiftright("mid", 33)
    runs = (dealt.groupBy("grp", part.alias("part"))
            .agg(F.min("mid").alias("low"), F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy("grp")         # a row for each range that holds some of the group
    placed = saved(runs, name + "_runs").select(
        "grp", "part", "low", F.sum("n").over(own).alias("size"),
        (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("base"))
    return (dealt.withColumn("part", part).join(placed, ["grp", "part"])
            .select(*rows.columns, (F.col("base") + F.col("mid") - F.col("low")).alias("at"), "size"))


def _blocks(kept: Sequence[str]) -> Callable:
    """Rows sorted by block; a block may go over several batches."""
    span = FAN_OUT ** LEVELS
    names = [*kept, "block", "path", "top", "copies"]

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        digests, changed = t.column("digest").to_pylist(), t.column("changed").to_pylist()
        paths, tops, copies, first = [], [], [], 0
        keys = zip(t.column("grp").to_pylist(), t.column("block").to_pylist(), t.column("size").to_pylist())
        for (_, _, size), run in groupby(keys):
            n = sum(1 for _ in run)
            tree = block_tree(digests[first:first + n], LEVELS if size > span else None)
            for i, new in enumerate(changed[first:first + n]):
                paths.append(path_of(tree, i))
                copies.append(None if new is None else copied_path(tree, i, new))
            tops += tree[-1] * n
            first += n
        made = pa.table([*(t.column(c) for c in kept), t.column("block"),
                         pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], _ARROW_PATH),
                         pa.array(tops, pa.string()), pa.array(copies, pa.list_(pa.string()))], names=names)
        yield from made.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            every = pa.Table.from_batches([batch])
            held = every if held is None else pa.concat_tables([held, every])
            if not held.num_rows:
                continue
            grp, block = held.column("grp").to_pylist(), held.column("block").to_numpy()
            last, cut = (grp[-1], block[-1]), held.num_rows - 1
            while cut and (grp[cut - 1], block[cut - 1]) == last:
                cut -= 1
            if cut:
                yield from solve(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from solve(held)

    return run


def climb(nodes: DataFrame, name: str, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` (grp, at, size, digest, changed and others) with their ``path`` to
    the root, their group's top ``subroot``, the ``root``, and for changed nodes
    the ``copies`` up to the version's root. ``above`` gives the same for the only
    nodes of their groups."""
    biggest = nodes.agg(F.max("size")).first()[0]
    if biggest is None or biggest <= 1:
        return above(nodes)
    kept = nodes.columns
    dealt = (nodes.withColumn("block", F.floor(F.col("at") / F.lit(FAN_OUT ** LEVELS)))
             .repartition("grp", "block").sortWithinPartitions("grp", "block", "at"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    built = saved(dealt.mapInArrow(
        tidy(_blocks(kept)), f"{fields}, block long, path {_PATH}, top string, copies array<string>"), name)
    tops = built.where(F.col("at") % FAN_OUT ** LEVELS == 0).select(
        "grp", F.col("block").alias("at"), F.ceil(F.col("size") / F.lit(FAN_OUT ** LEVELS)).alias("size"),
        F.col("top").alias("digest"), F.lit(None).cast("string").alias("changed"))
    up = climb(tops, name, above).select(
        "grp", F.col("at").alias("block"), F.col("path").alias("upper"), "subroot", "root")
    return built.join(up, ["grp", "block"]).select(
        *kept, F.concat("path", "upper").alias("path"), "subroot", "root",
        copies_along(F.col("copies"), F.col("upper")).alias("copies"))


def _whole(nodes: DataFrame) -> DataFrame:
    """The top of the tree above the groups."""
    return nodes.select("*", F.array().cast(_PATH).alias("path"), F.col("digest").alias("subroot"),
                        F.col("digest").alias("root"),
                        F.when(F.col("changed").isNotNull(), F.array("changed")).alias("copies"))


def _over_groups(name: str) -> Callable[[DataFrame], DataFrame]:
    def above(nodes: DataFrame) -> DataFrame:
        tops = nodes.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest",
                            F.lit(None).cast("string").alias("changed"))
        up = climb(ranked(tops, ["key"], name), name + "_blocks", _whole).select(
            F.col("key").alias("grp"), "path", "root")
        return nodes.join(up, "grp").select(
            *nodes.columns, "path", F.col("digest").alias("subroot"), "root",
            copies_along(F.when(F.col("changed").isNotNull(), F.array("changed")), F.col("path")).alias("copies"))
    return above


def manifest(leaves: DataFrame) -> DataFrame:
    """The manifest of ``leaves``: grp (a string that orders the groups), key, digest
    and changed (the digest of the tampered leaf; null: not tampered). Gives them
    with at, size, path, subroot, root and copies (see ``climb``)."""
    given = saved(leaves.select("grp", "key", "digest", "changed"), "merkle_leaves")
    places = ranked(given, ["key", "digest", "changed"], "merkle_places")
    return climb(places, "merkle_blocks", _over_groups("merkle_groups"))


def group_key(group: Column) -> Column:
    """Orders groups bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def copied_nodes(found: DataFrame) -> DataFrame:
    """The nodes that versions do not share with the tree: key and grp of the
    tampered leaf, level (0: the leaf) and digest."""
    return found.where("copies IS NOT NULL").select(
        "grp", "key", F.posexplode("copies").alias("level", "digest"))


def proof_digest(path: Column) -> Column:
    """sha256 over all siblings, level by level, left to right."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda s, x: F.concat(s, x["left"], x["right"])), 256)


def op11_rows(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of
    every document, where half of the documents are tampered with."""
    fields = {c: F.col(c) for c in FIELDS}
    picked = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    tampered = fields | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    leaves = docs.select(
        group_key(F.col("source")).alias("grp"), F.col("doc_id").cast("long").alias("key"),
        leaf(list(fields.values())).alias("digest"),
        F.when(picked & (F.instr("text", "\n") > 0), leaf(list(tampered.values()))).alias("changed"))
    found = manifest(leaves)
    reached = F.coalesce(F.element_at("copies", -1), folded(F.col("digest"), F.col("path")))
    return found.select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), reached.alias("folded_root"),
        (reached == F.col("root")).alias("verified"))
