"""Merkle dataset manifest: one tree per source, a tree of their roots, and every document's authentication path.

Leaves are ranked without gathering a source: a range partitioning deals them out in order, and running counts of its
partitions give every row its place. Blocks of ``ARITY ** BLOCK_LEVELS`` leaves, aligned to the tree, are folded to their tops, the
tops to the tops above them, until each tree has one node; so a tree of any size takes a few rounds, and no task holds more
than a block. Paths then come down from the root: each block is walked by fractal traversal, and the path of its top, made in the round
above, is appended to every path in the task that walks it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillstone.llm.common import broadcast_if_small, checkpointed, crc_mod, ship

#: Children of a node; levels of a block; levels of each of the stacked subtrees that a traversal keeps.
ARITY, BLOCK_LEVELS, SUBTREE_LEVELS = 16, 3, 1
#: Rows of a table that a traversal returns.
OUT_ROWS = 2048
_NODES = "tree string, block long, rank long, n long, node binary"
_PATHS = "tree string, rank long, path array<string>, subroot string, root string"


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int, arity: int = ARITY) -> int:
    """Levels above n leaves: none above a lone one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


class Subtree:
    """The nodes under one node of level ``top``, of the levels from ``low`` on, grown leaf by leaf.

    Of each level below, only the open run is held: what a run closes with goes up, as in a tree hash with a stack.
    """

    def __init__(self, start: int, stop: int, low: int, top: int, arity: int):
        self.next, self.stop, self.top, self.arity = start, stop, top, arity
        self.kept: dict[int, list[str]] = {level: [] for level in range(low, top)}
        self.first = {level: start // arity**level for level in self.kept}
        self.open: list[list[str]] = [[] for _ in range(top)]
        self.root: str | None = None

    def grow(self, leaves: list[str]) -> None:
        """Take in the next leaf, if one is left; the last one closes every run."""
        if self.next == self.stop:
            return
        node = leaves[self.next]
        self.next += 1
        last = self.next == self.stop
        for level in range(self.top):
            if level in self.kept:
                self.kept[level].append(node)
            run = self.open[level]
            run.append(node)
            if len(run) < self.arity and not last:
                return
            node = node_hash("".join(run))
            run.clear()
        self.root = node

    def grown(self, leaves: list[str]) -> Subtree:
        while self.next < self.stop:
            self.grow(leaves)
        return self

    def siblings(self, leaf: int, level: int) -> tuple[str, str]:
        """What stands left and right of the leaf's ancestor of that level in its run, each concatenated."""
        nodes, at = self.kept[level], leaf // self.arity**level - self.first[level]
        run = at - at % self.arity
        return "".join(nodes[run:at]), "".join(nodes[at + 1 : run + self.arity])


def block_top(leaves: list[str], levels: int, arity: int = ARITY) -> str:
    """The node that stands ``levels`` above the leaves."""
    return Subtree(0, len(leaves), levels, levels, arity).grown(leaves).root if levels else leaves[0]


def authentication_paths(leaves: list[str], levels: int, arity: int = ARITY, subtree_levels: int = SUBTREE_LEVELS) -> Iterator[list[str]]:
    """Of each leaf in turn the path up ``levels``: left and right siblings of the lowest level, of the next, and so on.

    Stacked subtrees, one for each run of ``subtree_levels`` levels, hold the present nodes. Under each but the topmost, the one to come
    is grown beside it by one leaf a step, and takes its place when the walk enters it.
    """
    bounds = [(low, min(low + subtree_levels, levels)) for low in range(0, levels, subtree_levels)]
    n = len(leaves)
    existing: list[Subtree] = []
    desired: list[Subtree | None] = [None] * len(bounds)
    for low, top in bounds:
        existing.append(Subtree(0, min(arity**top, n), low, top, arity).grown(leaves))
    for i in range(n):
        path: list[str] = []
        for s, (low, top) in enumerate(bounds):
            span = arity**top
            if i % span == 0:
                if i:
                    existing[s] = desired[s]
                desired[s] = Subtree(i + span, min(i + 2 * span, n), low, top, arity) if i + span < n else None
            if desired[s] is not None:
                desired[s].grow(leaves)
            for level in range(low, top):
                path += existing[s].siblings(i, level)
        yield path


def folded(node: str, path: list[str]) -> str:
    """The root that a node and its path give."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        node = node_hash(f"{left}{node}{right}")
    return node


def ranked(rows: DataFrame, order: list[str], arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """rows, keyed by ``tree``, with rank (from 0, by ``order``), n (rows of the tree) and block (of ``arity ** block_levels`` ranks).

    Rows are dealt out by range, so that a tree with most of all rows takes as many tasks as it needs; a partition's
    rows of a tree are numbered in place and moved by the count of those in partitions before.
    """
    dealt = checkpointed(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    runs = dealt.groupBy("tree", part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("__rows").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = checkpointed(runs.select("tree", "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__move"), F.sum("__rows").over(tree).alias("n")))
    placed = dealt.withColumn("__part", part).join(broadcast_if_small(runs), ["tree", "__part"])
    rank = F.col("__at") + F.col("__move")
    return placed.withColumns({"rank": rank, "block": F.floor(rank / arity**block_levels).cast("long")}).drop("__at", "__part", "__move")


def _by_block(rows: DataFrame) -> DataFrame:
    """Blocks whole in one partition, ranks ascending; the row of what is above a block, of rank -1, comes first."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], dict[str, list]]]:
    """(tree, block) and the columns of each block, from rows sorted by them."""
    key, held = None, None
    for batch in batches:
        columns = batch.to_pydict()
        keys = list(zip(columns["tree"], columns["block"], strict=True))
        start = 0
        while start < len(keys):
            stop = start + 1
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            if keys[start] != key:
                if held is not None:
                    yield key, held
                key, held = keys[start], {c: [] for c in columns}
            for c, values in columns.items():
                held[c] += values[start:stop]
            start = stop
    if held is not None:
        yield key, held


def tops(nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The node above each block of nodes(tree, block, rank, n, node), as nodes of the round above."""
    size = arity**block_levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ("tree", "block", "rank", "n", "node")}
        for (tree, block), rows in _blocks(batches):
            n = rows["n"][0]
            top = block_top([x.hex() for x in rows["node"]], min(height(n, arity), block_levels), arity)
            for c, v in zip(out, (tree, block // size, block, -(-n // size), bytes.fromhex(top)), strict=True):
                out[c].append(v)
            if len(out["tree"]) >= OUT_ROWS:
                yield pa.RecordBatch.from_pydict(out)
                out = {c: [] for c in out}
        if out["tree"]:
            yield pa.RecordBatch.from_pydict(out)

    return _by_block(nodes.select("tree", "block", "rank", "n", "node")).mapInArrow(run, _NODES)


def walked(nodes: DataFrame, above: DataFrame, kept: list[str], emit: Callable[..., tuple], schema: str, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """What ``emit`` makes of each node and its path to the root, from rows ``above`` of the blocks' tops.

    above: tree, rank (the number of the block), path (array of strings), subroot, root. emit gets tree, rank, node and the kept
    columns of a row as a tuple, then path, subroot and root, and returns a tuple in the order of ``schema``.
    """
    heads = above.select("tree", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"), "path", "subroot", "root")
    out_schema = to_arrow_schema(nodes.sparkSession.createDataFrame([], schema).schema)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), out_schema, strict=True)], schema=out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, _), rows in _blocks(batches):
            path, subroot, root = rows["path"][0], rows["subroot"][0], rows["root"][0]
            leaves = [x.hex() for x in rows["node"][1:]]
            levels = min(height(rows["n"][1], arity), block_levels)
            columns = [rows[c][1:] for c in kept]
            for low, rank, leaf, *more in zip(authentication_paths(leaves, levels, arity), rows["rank"][1:], leaves, *columns, strict=True):
                out.append(emit((tree, rank, leaf, *more), low + path, subroot, root))
                if len(out) >= OUT_ROWS:
                    yield packed(out)
                    out = []
        if out:
            yield packed(out)

    return _by_block(nodes.select("tree", "block", "rank", "n", "node", *kept).unionByName(heads, allowMissingColumns=True)).mapInArrow(run, schema)


def _rounds(nodes: DataFrame, arity: int, block_levels: int) -> list[DataFrame]:
    """Tops of the nodes' blocks, tops of those, and so on; the last has one node a tree."""
    out = [checkpointed(tops(nodes, arity, block_levels))]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(checkpointed(tops(out[-1], arity, block_levels)))
    return out


def _descended(rounds: list[DataFrame], above: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """The paths of the nodes of the first round, from ``above``, those of the last."""
    for nodes in reversed(rounds[:-1]):
        above = checkpointed(walked(nodes, above, [], lambda row, path, subroot, root: (*row[:2], path, subroot, root), _PATHS, arity, block_levels))
    return above


def manifest(leaves: DataFrame, order: list[str], kept: list[str], emit: Callable[..., tuple], schema: str, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``emit`` of every leaf of leaves(tree, node, order, kept) with its path to the root over all trees; see ``walked``.

    Trees follow each other by their name's bytes.
    """
    ship(leaves.sparkSession)
    base = ranked(leaves, order, arity, block_levels)
    rounds = _rounds(base, arity, block_levels)
    subroots = ranked(rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node"), ["of"], arity, block_levels)
    upper = _rounds(subroots, arity, block_levels)
    root = upper[-1].select("tree", "rank", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("node")).alias("root"))
    own = lambda row, path, _, root: (row[3], 0, path, row[2], root)
    above = checkpointed(walked(subroots, _descended(upper, root, arity, block_levels), ["of"], own, _PATHS, arity, block_levels))
    return walked(base, _descended(rounds, above, arity, block_levels), kept, emit, schema, arity, block_levels)


def field(c: Column) -> Column:
    """A value as a leaf holds it: its UTF-8 byte count, a colon and itself; a hyphen if null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def dataset_manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tampered: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes the fields. Leaves of a source ascend by id (null first; ties by leaf; rows alike in both are
    leaves of their own beside each other); sources ascend by their bytes, null first. ``tampered`` gives other values of fields; folded_root is
    what the leaf with these values and the untampered siblings give, and verified tells whether that is the root. Null
    and empty values differ. Columns that no argument names are not read, so their names can't clash. An empty table gives no rows.
    """
    leaf = lambda other: F.unhex(F.sha2(F.concat(*[field(other.get(c, F.col(c))) for c in fields]), 256))
    source = F.col(source_col).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("tree"), F.col(id_col).alias("doc_id"), leaf({}).alias("node"),
        (leaf(tampered) if tampered else F.lit(None).cast("binary")).alias("other"), F.monotonically_increasing_id().alias("salt"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def emit(row: tuple, path: list[str], subroot: str, root: str) -> tuple:
        _, _, own, doc_id, other = row
        back = folded(own if other is None else other.hex(), path)
        return doc_id, own, subroot, root, node_hash("".join(path)), back, back == root

    # Checkpointed first, so that texts are read and hashed once.
    return manifest(checkpointed(rows), ["doc_id", "node", "salt"], ["doc_id", "other"], emit, schema)


def tampered_text(id_col: str = "doc_id", text_col: str = "text", share: int = 5) -> dict[str, Column]:
    """Where ``share`` divides the crc32 of the id, the text with A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return {text_col: F.when(crc_mod(F.col(id_col), share) == 0, F.translate(text_col, upper, upper.lower())).otherwise(F.col(text_col))}


_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(1, length(id) + 1), lambda i: ord(substr(id, i, 1))::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: 0::UBIGINT)), lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)))"""


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _levels_sql(name: str, leaves: str) -> str:
    """A recursive CTE of the nodes (lvl, tree, pos, node) above the leaves of every tree."""
    return f"""{name} AS (
  SELECT 0 AS lvl, tree, pos, node FROM {leaves} UNION ALL
  SELECT lvl + 1, tree, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS width FROM {name}) WHERE width > 1 GROUP BY lvl, tree, pos // {ARITY}
)"""


def _paths_sql(leaves: str, nodes: str) -> str:
    """Of each leaf the siblings at every level, lowest first, as 'left|right'."""
    return f"""
  SELECT tree, pos, list(l || '|' || r ORDER BY lvl) AS steps FROM (
    SELECT d.tree, d.pos, n.lvl,
           coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < d.pos // ({ARITY} ** n.lvl)::BIGINT), '') AS l,
           coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > d.pos // ({ARITY} ** n.lvl)::BIGINT), '') AS r
    FROM {leaves} d JOIN (SELECT *, max(lvl) OVER (PARTITION BY tree) AS top FROM {nodes}) n ON n.tree = d.tree AND n.lvl < n.top AND n.pos // {ARITY} = d.pos // ({ARITY} ** (n.lvl + 1))::BIGINT
    GROUP BY ALL) GROUP BY ALL"""


_LEAF_SQL = "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars"))) + " || coalesce(strlen({0}) || ':' || {0}, '-'))"
OP11_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, {_LEAF_SQL.format('text')} AS leaf, coalesce('s' || source, '') AS tree, doc_id::VARCHAR AS id FROM documents
), leaves AS (
  SELECT doc_id, tree, leaf AS node, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN {_CRC32} % 5 = 0 THEN {_LEAF_SQL.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE leaf END AS other
  FROM docs
), {_levels_sql('nodes', 'leaves')}, subroots AS (
  SELECT tree AS of, node, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM (SELECT tree, arg_max(node, lvl) AS node FROM nodes GROUP BY 1)
), {_levels_sql('tops', 'subroots')}, lower_paths AS ({_paths_sql('leaves', 'nodes')}
), upper_paths AS ({_paths_sql('subroots', 'tops')}
), whole AS (
  SELECT d.doc_id, d.node AS leaf, d.other, s.node AS subroot, (SELECT arg_max(node, lvl) FROM tops) AS root, list_concat(coalesce(l.steps, []), coalesce(u.steps, [])) AS steps
  FROM leaves d JOIN subroots s ON s.of = d.tree LEFT JOIN lower_paths l ON l.tree = d.tree AND l.pos = d.pos LEFT JOIN upper_paths u ON u.pos = s.pos
), folded AS (
  SELECT *, list_reduce(list_prepend(other, steps), lambda node, x: sha256(split_part(x, '|', 1) || node || split_part(x, '|', 2))) AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
