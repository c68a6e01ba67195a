"""A Merkle tree over documents whose parents keep copied SHA-256 states.

A leaf is the SHA-256 of a document's fields. Per group (the language) leaves ascend by key, and
every ``fanout`` consecutive nodes become one parent, the hash of their hex digests put together,
until one node is left, the group's subroot. The subroots, in the order of their groups, become
the root in the same way.

A parent keeps a copy of its hash state before each child slot. Folding a changed node resumes
the state before its slot, takes in the replacement and the siblings to the right only, and goes
on so in the parent above; what is to the left is never hashed again.

Hash states cannot leave a process, so a tree is cut into blocks of ``BLOCK_LEVELS`` levels:

1. Leaves get their position in the group from a range-partitioned numbering.
2. All leaves of a block (at most ``fanout ** BLOCK_LEVELS``) make its top node in one task.
   Tops are the leaves of the next layer, until each group has one node; layers shrink by the
   size of a block.
3. From the last layer down, every block hands each of its leaves the siblings on the way up.
4. In the lowest layer a task builds its block's parents with their states, and parents with
   states for the way up from the block's top, and then proves and folds the block's leaves.

So no task holds more than one block and no driver any part of the tree; only the last layer,
one row per group, has as many rows as there are groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.lines import number_rows
from larkspur.session import stored

FANOUT = 2
#: Levels of a block.
BLOCK_LEVELS = 10
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A way up: per level the slot and the children of the parent.
PATH = "array<struct<slot:int,children:array<string>>>"
#: Rows of a batch that a task hands on.
ROWS_AT_ONCE = 4096

_HASH = hashlib.sha256
_PATH = pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.list_(pa.string()))]))


class Parent:
    """A parent node: its digest, its children, and the hash state before each of them."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: Sequence[str]):
        self.children = [c.encode() for c in children]
        self.states = []
        state = _HASH()
        for child in self.children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> str:
        return b"".join([*self.children[:slot], *self.children[slot + 1:]]).decode()

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child in ``slot``."""
        state = self.states[slot].copy()
        state.update(replacement.encode())
        for child in self.children[slot + 1:]:
            state.update(child)
        return state.hexdigest()


def block_levels(nodes: Sequence[str], fanout: int, levels: int) -> list[list[Parent]]:
    """The parents of a block, level by level; ``levels`` of them, even above a single node."""
    above = []
    for _ in range(levels):
        parents = [Parent(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        above.append(parents)
        nodes = [p.digest for p in parents]
    return above


def levels_of(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields, each as ``-`` or its length in UTF-8 bytes, ``:`` and its value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                                F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows that agree in their first ``keys`` columns, from rows sorted by these."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != current:
                if rows:
                    yield rows
                current, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield rows


def _by_block(nodes: DataFrame, *then: str) -> DataFrame:
    return nodes.repartition("grp", "block").sortWithinPartitions("grp", "block", *then)


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, ROWS_AT_ONCE)):
        columns = zip(*held, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


class _Layer:
    """The nodes of one layer: ``grp``, ``pos`` (from 0), ``hash``, ``size`` (the group's nodes)
    and ``block``, all of it written once."""

    def __init__(self, nodes: DataFrame, fanout: int, levels: int):
        self.fanout, self.levels = fanout, levels
        self.nodes = nodes.withColumn(
            "block", F.floor(F.col("pos") / F.lit(fanout ** levels)).cast("bigint"))

    def tops(self) -> DataFrame:
        """The next layer's nodes, one per block."""
        fanout, most = self.fanout, self.levels

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for run in _runs(batches, 2):
                    grp, block, _, size, _ = run[0]
                    levels = min(most, levels_of(size, fanout))
                    hashes = [r[4] for r in run]
                    if levels:
                        hashes = [p.digest for p in block_levels(hashes, fanout, levels)[-1]]
                    yield grp, block, -(-size // fanout ** most), hashes[0]

            return _batches(rows(), {"grp": pa.int64(), "pos": pa.int64(), "size": pa.int64(),
                                     "hash": pa.string()})

        ordered = _by_block(self.nodes.select("grp", "block", "pos", "size", "hash"), "pos")
        return ordered.mapInArrow(build, "grp long, pos long, size long, hash string")


def _paths(layer: _Layer, above: DataFrame) -> DataFrame:
    """For every node of ``layer`` the way from it to its group's subroot: ``grp``, ``pos`` and
    ``path``. ``above`` has the ways on from the blocks' tops in the same columns."""
    fanout, most = layer.fanout, layer.levels
    own = layer.nodes.select("grp", "block", "pos", "size", "hash", F.lit(None).cast(PATH).alias("path"))
    # One row of the layer above a block, put in front of the block's own rows.
    nodes = own.unionByName(above.select(
        "grp", F.col("pos").alias("block"), F.lit(-1).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("size"), F.lit("").alias("hash"), "path"))

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _runs(batches, 2):
                path, run = run[0][5], run[1:]
                above_here = block_levels(
                    [r[4] for r in run], fanout, min(most, levels_of(run[0][3], fanout)))
                for at, r in enumerate(run):
                    own, i = [], at
                    for parents in above_here:
                        parent = parents[i // fanout]
                        own.append({"slot": i % fanout, "children": [
                            c.decode() for c in parent.children]})
                        i //= fanout
                    yield r[0], r[2], own + path

        return _batches(rows(), {"grp": pa.int64(), "pos": pa.int64(), "path": _PATH})

    return _by_block(nodes, "pos").mapInArrow(ways, f"grp long, pos long, path {PATH}")


def _ways(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Subroots (``grp``, ``hash``) of a first layer, and for the tops of its blocks the ways to
    these (``grp``, ``pos``, ``path``). The number of layers is a logarithm of the largest group."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    layers = [_Layer(nodes, fanout, levels)]
    while most > 1:
        most = -(-most // fanout ** levels)
        layers.append(_Layer(stored(layers[-1].tops()), fanout, levels))
    if len(layers) == 1:  # groups of one node each, or no rows
        layers.append(_Layer(stored(layers[0].tops()), fanout, levels))
    # A group that has one node stays one node in the layers above.
    subroots = layers[-1].nodes.select("grp", "hash")
    ways = layers[-1].nodes.select("grp", "pos", F.array().cast(PATH).alias("path"))
    for layer in reversed(layers[1:-1]):
        ways = _paths(layer, ways)
    return subroots, ways


def prove_and_fold(docs: DataFrame, leaf: Column, changed: Column, key: str = "doc_id",
                   group: str = "lang", fanout: int = FANOUT, levels: int = BLOCK_LEVELS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs``: the ``key``, the ``keep`` columns, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256`` (of all siblings, level by level up to the root) and ``folded_root``, the root
    with ``changed`` in the place of this leaf alone.

    ``leaf`` and ``changed`` are digests as hex text; where ``changed`` is null the leaf is folded as
    it is. Rows without a group are a group of their own, which comes first. Within a group null
    keys come first; rows that repeat a key follow one another by their leaves, so equal rows get
    neighbouring places. No rows give no rows.
    """
    rows = stored(docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("name"),
        *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)),
        leaf.alias("leaf"), changed.alias("changed")))
    # The last column tells equal rows apart, so that copies can be spread like other rows.
    order = [F.asc_nulls_first("name"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("row")]
    indexed = number_rows(rows.withColumn("row", F.monotonically_increasing_id()), order)
    groups = indexed.groupBy("name").agg(F.min("index").alias("first"),
                                         F.count(F.lit(1)).alias("size"))
    groups = stored(number_rows(groups, [F.asc_nulls_first("name")], "grp"))
    g = groups.withColumnRenamed("name", "group_name")
    placed = stored(indexed.join(g, indexed["name"].eqNullSafe(g["group_name"]))
                    .withColumn("pos", F.col("index") - F.col("first"))
                    .drop("group_name", "first", "index", "row", "name"))
    nodes = placed.select("grp", "pos", "size", F.col("leaf").alias("hash"))
    subroots, ways = _ways(nodes, fanout, levels)

    # The tree of the subroots: one group, whose positions are the groups' numbers.
    n_groups = groups.agg(F.count(F.lit(1)).alias("n")).scalar()
    tops = stored(subroots.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("pos"),
                                  n_groups.alias("size"), "hash"))
    roots, upper = _ways(tops, fanout, levels)
    upper = _paths(_Layer(tops, fanout, levels), upper)
    whole = (upper.select(F.col("pos").alias("grp"), F.col("path").alias("on"))
             .join(subroots.select("grp", F.col("hash").alias("subroot")), "grp")
             .withColumn("root", stored(roots.select("hash")).select("hash").scalar()))
    # Per block: the ways on from its top, to the subroot and to the root.
    ways = ways.join(whole, "grp").select(
        "grp", F.col("pos").alias("block"), "path", "on", "subroot", "root")
    return _fold_blocks(placed, ways, key, keep, fanout, levels)


def _fold_blocks(placed: DataFrame, ways: DataFrame, key: str, keep: Sequence[str], fanout: int,
                 levels: int) -> DataFrame:
    kept = [f"keep_{i}" for i in range(len(keep))]
    columns = ["grp", "block", "pos", "size", "leaf", "changed", "path", "on", "subroot", "root",
               "key", *kept]
    leaves = placed.withColumn(
        "block", F.floor(F.col("pos") / F.lit(fanout ** levels)).cast("bigint"))
    types = dict(leaves.dtypes)

    def missing(name: str, kind: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    own = leaves.select(*columns[:6], missing("path", PATH), missing("on", PATH),
                        missing("subroot", "string"), missing("root", "string"), "key", *kept)
    first = ways.select("grp", "block", F.lit(-1).cast("bigint").alias("pos"),
                        F.lit(0).cast("bigint").alias("size"), missing("leaf", "string"),
                        missing("changed", "string"), "path", "on", "subroot", "root",
                        *(missing(c, types[c]) for c in ("key", *kept)))
    n_kept = len(kept) + 1

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        def rows() -> Iterator[tuple]:
            for run in _runs(seen(), 2):
                _, _, _, _, _, _, path, on, subroot, root = run[0][:10]
                # The way up from the block's top, with a state before each slot.
                way = [(Parent(p["children"]), p["slot"]) for p in [*path, *on]]
                rest = "".join(parent.siblings(slot) for parent, slot in way)
                run = run[1:]
                above = block_levels([r[4] for r in run], fanout,
                                     min(levels, levels_of(run[0][3], fanout)))
                proofs = [rest]
                for parents in reversed(above):
                    proofs = [p.siblings(s) + proofs[i] for i, p in enumerate(parents)
                              for s in range(len(p.children))]
                for at, r in enumerate(run):
                    node, i = r[5] or r[4], at
                    for parents in above:
                        node, i = parents[i // fanout].fold(i % fanout, node), i // fanout
                    for parent, slot in way:
                        node = parent.fold(slot, node)
                    yield (*r[10:10 + n_kept], r[4], subroot, root,
                           _HASH(proofs[at].encode()).hexdigest(), node)

        names = ["key", *kept, "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        source = rows()
        while held := list(islice(source, ROWS_AT_ONCE)):
            kinds = [*(schema.field(10 + i).type for i in range(n_kept)), *[pa.string()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)],
                names)

    fields = ", ".join(f"{c} {types[c]}" for c in ("key", *kept))
    folded = _by_block(own.unionByName(first), "pos").mapInArrow(
        fold, f"{fields}, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string")
    return folded.select(F.col("key").alias(key),
                         *(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)),
                         "leaf", "subroot", "root", "proof_sha256", "folded_root")


def tampered(key: str = "doc_id") -> Column:
    """Whether 7 divides the CRC-32 of the key as text; rows without a key are left alone."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` in which every seventh document or so has another ``n_chars``:
    ``verified`` tells whether the root folded from a row as it is now equals the root."""
    fields = [F.col(c) for c in FIELDS]
    other = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    folded = prove_and_fold(docs, leaf_digest(fields),
                            F.when(tampered(), leaf_digest(other)))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
