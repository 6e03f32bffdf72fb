"""A Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

Method: every row is a leaf, the digest of its fields. The rows of one group are a tree of arity 8 in the
order of their ids; the groups' roots, in the order of the groups, are one more such tree. A tree is stored as aligned
subtrees of ``HEIGHT`` levels, one row each. A subtree is laid out by splitting it at half its height: first
the upper part, then the lower parts one after the other, each laid out in the same way. Where a node stands is
arithmetic on its depth and index (``address``), for any size of cache or page; building a subtree and fetching a node's
siblings both go through it. The roots of the subtrees are the leaves of the next tier, until
one subtree is left of each tree; on the way down each subtree hands the siblings above its leaves
to the subtrees below. So the work per task is one subtree whatever the size of a group, and the
number of tiers is the logarithm of the rows to base 4,096.

Rows are placed by one range sort of ids and digests; the texts are read once and never exchanged.

Defined results: a null is hashed as ``-``, so it differs from an empty text; null ids come first, rows
with equal ids are ordered by their digests, repeated rows are leaves of their own, with equal digests;
a null group comes first and is a group of its own; a group of one row has its leaf as root; an
empty table gives no rows; texts of any length are hashed whole; columns that are not hashed may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import with_row_index
from ..session import staged
from .common import spread_join

ARITY = 8
#: Levels of parents in one stored subtree.
HEIGHT = 4
SPAN = ARITY ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32

SUBTREES = "tree long, block long, n long, height int, nodes binary, root binary, ids array<long>, claims array<binary>"
PATHS = "tree long, block long, before array<binary>, after array<binary>, subroot binary, root binary"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def nodes_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels of nodes."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes of a depth (the root's is 0) stand in a tree of so many levels of nodes."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    each = ARITY ** (depth - top)
    return nodes_of(top) + index // each * nodes_of(levels - top) + address(depth - top, index % each, levels - top)


def height_for(leaves: int) -> int:
    """Levels of parents above so many leaves."""
    height = 0
    while ARITY ** height < leaves:
        height += 1
    return height


def widths(leaves: int, height: int) -> list[int]:
    """Nodes at each depth, from the root down."""
    out = [leaves]
    for _ in range(height):
        out.append(-(-out[-1] // ARITY))
    return out[::-1]


def subtree(leaves: np.ndarray, height: int) -> np.ndarray:
    """All nodes (rows of 32 bytes) of the subtree of so many levels over these leaves; absent ones are zero."""
    nodes = np.zeros((nodes_of(height + 1), DIGEST), np.uint8)
    wide = widths(len(leaves), height)
    below = address(height, np.arange(wide[height]), height + 1)
    nodes[below] = leaves
    for depth in reversed(range(height)):
        parents = address(depth, np.arange(wide[depth]), height + 1)
        for i, parent in enumerate(parents):
            children = nodes[below[i * ARITY:(i + 1) * ARITY]]
            nodes[parent] = np.frombuffer(sha256(children.tobytes().hex().encode()).digest(), np.uint8)
        below = parents
    return nodes


Path = list[tuple[bytes, bytes]]


def paths(nodes: np.ndarray, leaves: int, height: int, above: Path) -> Iterator[tuple[bytes, Path]]:
    """Each leaf and its siblings to the left and right, level by level up to the root and on by ``above``."""
    wide, held = widths(leaves, height), [above]
    for depth in range(1, height + 1):
        level = nodes[address(depth, np.arange(wide[depth]), height + 1)].tobytes()
        lower = []
        for parent, path in enumerate(held):
            run = level[parent * ARITY * DIGEST:(parent + 1) * ARITY * DIGEST]
            lower += [[(run[:at], run[at + DIGEST:]), *path] for at in range(0, len(run), DIGEST)]
        held = lower
    level = nodes[address(height, np.arange(leaves), height + 1)].tobytes()
    return ((level[i * DIGEST:(i + 1) * DIGEST], path) for i, path in enumerate(held))


def folded(leaf: bytes, path: Path) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for before, after in path:
        leaf = sha256((before + leaf + after).hex().encode()).digest()
    return leaf


def proof_digest(path: Path) -> str:
    return sha256(b"".join(before + after for before, after in path).hex().encode()).hexdigest()


def digest(fields: list[Column]) -> Column:
    """The leaf of a row: of each field the UTF-8 length, a colon and the value, or ``-``."""
    parts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """The subtrees of all groups by tiers from the leaves up, those over the groups' roots, and the groups (key, tree)."""

    tiers: list[DataFrame]
    upper: list[DataFrame]
    trees: DataFrame


def _tier(leaves: DataFrame) -> DataFrame:
    """The subtrees over ``leaves(tree, place, n, leaf, id, claim)``, a task's work being one of them."""
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n, count = table.column("n")[0].as_py(), table.num_rows
        height = min(HEIGHT, height_for(n))
        nodes = subtree(np.frombuffer(b"".join(table.column("leaf").to_pylist()), np.uint8).reshape(count, DIGEST), height)
        row = {"tree": table.column("tree")[0].as_py(), "block": table.column("block")[0].as_py(), "n": n, "height": height, "nodes": nodes.tobytes(),
               "root": nodes[0].tobytes(), "ids": table.column("id").to_pylist(), "claims": table.column("claim").to_pylist()}
        return pa.Table.from_pylist([row], _subtree_type())

    blocks = leaves.withColumn("block", F.expr(f"place div {SPAN}"))
    return blocks.groupBy("tree", "block").applyInArrow(build, SUBTREES)


def _subtree_type() -> pa.Schema:
    return pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("height", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
                      ("ids", pa.list_(pa.int64())), ("claims", pa.list_(pa.binary()))])


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    out = []
    while not out or not leaves.isEmpty():
        out.append(staged(_tier(leaves), "subtrees"))
        roots = out[-1].filter(F.col("n") > SPAN)
        leaves = roots.select("tree", F.col("block").alias("place"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"), F.col("root").alias("leaf"),
                              F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim"))
    return out


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """(tree, root): the last subtree of each tree covers all of it."""
    return reduce(DataFrame.union, [t.filter(F.col("n") <= SPAN).select("tree", "root") for t in tiers])


def manifest(docs: DataFrame, by: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, claim: Column | None = None) -> Manifest:
    """The manifest of a dataset. ``claim``, where it is not null, is a digest to be held against it in place of the row's own."""
    claim = F.lit(None).cast("binary") if claim is None else claim
    key = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("-"))  # "-" sorts before "="
    rows = staged(docs.select(key.alias("key"), F.col(order).cast("long").alias("id"), digest([F.col(f) for f in fields]).alias("leaf"), claim.alias("claim")), "leaves")
    # the last part of the order spreads repeated rows over several ranges
    sorted_rows = with_row_index(rows.withColumn("salt", F.monotonically_increasing_id()), "key", "id", "leaf", "salt", name="at")
    groups = staged(sorted_rows.groupBy("key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "groups")
    trees = staged(with_row_index(groups, "key", name="tree"), "trees")
    placed = spread_join(sorted_rows, trees, "key", ["at"])
    tiers = _tiers(placed.select("tree", (F.col("at") - F.col("first")).alias("place"), "n", "leaf", "id", "claim"))
    upper = _tiers(_tops(tiers).select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("place"), F.lit(trees.count()).cast("long").alias("n"),
                                       F.col("root").alias("leaf"), F.col("tree").alias("id"), F.lit(None).cast("binary").alias("claim")))
    return Manifest(tiers, upper, trees.select("key", "tree", "n"))


def _met(tiers: list[DataFrame], tops: DataFrame, level: int, handed: DataFrame | None) -> DataFrame:
    """The subtrees of a tier with the siblings above their roots: handed down, or of a whole tree."""
    ends = tiers[level].filter(F.col("n") <= SPAN).select("tree", "block").join(tops, "tree")
    known = ends if handed is None else ends.unionByName(handed)
    return tiers[level].join(known.select("tree", "block", "before", "after", "subroot", F.col("root").alias("whole")), ["tree", "block"])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int, Iterator[tuple[bytes, Path]]]]:
    """The subtrees one by one: the row, the place of its first leaf, its leaves with their paths."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
            yield row, row["block"] * SPAN, paths(nodes, len(row["ids"]), row["height"], list(zip(row["before"], row["after"])))


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    many = pa.list_(pa.binary())
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("before", many), ("after", many), ("subroot", pa.binary()), ("root", pa.binary())])
    for row, first, found in _each(batches):
        yield pa.RecordBatch.from_pylist([
            {"tree": row["tree"], "block": first + i, "before": [b for b, _ in path], "after": [a for _, a in path], "subroot": row["subroot"], "root": row["whole"]}
            for i, (_, path) in enumerate(found)], schema)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text = pa.string()
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", text), ("subroot", text), ("root", text), ("proof_sha256", text), ("folded_root", text)])
    for row, _, found in _each(batches):
        whole, subroot = row["whole"].hex(), row["subroot"].hex()
        out = [(leaf.hex(), subroot, whole, proof_digest(path), folded(leaf if claim is None else claim, path).hex()) for claim, (leaf, path) in zip(row["claims"], found)]
        yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), *[pa.array(c, text) for c in zip(*out)]], schema=schema)


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: its claim, if any, held against the manifest."""
    none = F.array().cast("array<binary>")
    tops = _tops(made.upper).select("tree", none.alias("before"), none.alias("after"), F.col("root").alias("subroot"), "root")
    handed = None
    for level in reversed(range(len(made.upper))):
        handed = _met(made.upper, tops, level, handed).mapInArrow(_hand_down, PATHS)
    # the leaves of the tree of groups are the roots of the groups' trees; their number there is the group's
    subroots = _tops(made.tiers).withColumnRenamed("root", "own")
    groups = handed.select((F.col("block") + 1).alias("tree"), "before", "after", "root")
    tops = staged(groups.join(subroots, "tree").select("tree", "before", "after", F.col("own").alias("subroot"), "root"), "group-paths")
    handed = None
    for level in reversed(range(1, len(made.tiers))):
        handed = _met(made.tiers, tops, level, handed).mapInArrow(_hand_down, PATHS)
    found = _met(made.tiers, tops, 0, handed).mapInArrow(_prove, PROOFS)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_STEP = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(s, CAST(i // 8 + 1 AS BIGINT), 1))) ELSE c END"
_CRC32 = f"xor(list_reduce(range(0, 8 * length(s)), lambda c, i: xor(({_STEP}) >> 1, (({_STEP}) & 1) * 3988292384), CAST(4294967295 AS BIGINT)), 4294967295)"


def _field(name: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({name} AS VARCHAR))) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


def _levels_sql(name: str, depth: int) -> str:
    """``{name}0(grp, idx, h, n)``, then each level of its trees with the siblings before and after every node."""
    out = []
    for k in range(depth):
        run = f"PARTITION BY grp, idx // {ARITY} ORDER BY idx"
        out.append(f"""{name}{k}s AS MATERIALIZED (SELECT grp, idx, h, n,
            coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
            coalesce(string_agg(h, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT grp, idx // {ARITY} AS idx,
            CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h, (max(n) + {ARITY - 1}) // {ARITY} AS n FROM {name}{k} GROUP BY grp, idx // {ARITY})""")
    return ",\n".join(out)


def _fold_sql(name: str, depth: int) -> str:
    """``{name}f0(doc_id, grp, pos, proof, fold)`` carried up level by level."""
    out = []
    for k in range(depth):
        out.append(f"""{name}f{k + 1} AS MATERIALIZED (SELECT f.* EXCLUDE (pos, proof, fold), f.pos // {ARITY} AS pos, proof || before || after AS proof,
            CASE WHEN n = 1 THEN fold ELSE sha256(before || fold || after) END AS fold
            FROM {name}f{k} f JOIN {name}{k}s s ON f.grp IS NOT DISTINCT FROM s.grp AND f.pos = s.idx)""")
    return ",\n".join(out)


def oracle(depth: int = 10, groups_depth: int = 4) -> str:
    """DuckDB SQL for groups of up to 8^depth rows and up to 8^groups_depth groups."""
    own = " || ".join(map(_field, FIELDS))
    folded_text = " || ".join(_field(f) if f != "text" else _field("lowered") for f in FIELDS)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH held AS MATERIALIZED (
    SELECT doc_id, lang, sha256({own}) AS leaf, CASE WHEN doc_id IS NOT NULL AND crc % 3 = 0 THEN sha256({folded_text}) ELSE sha256({own}) END AS claim
    FROM (SELECT *, {_CRC32} AS crc, translate(text, '{letters}', '{letters.lower()}') AS lowered FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents))
), d0 AS MATERIALIZED (
    SELECT doc_id, leaf, claim, lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM held
), {_levels_sql("d", depth)},
g0 AS MATERIALIZED (
    SELECT 0 AS grp, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, h, count(*) OVER () AS n FROM (SELECT grp AS lang, h FROM d{depth})
), {_levels_sql("g", groups_depth)},
df0 AS MATERIALIZED (SELECT doc_id, leaf, grp, idx AS pos, '' AS proof, claim AS fold FROM d0),
{_fold_sql("d", depth)},
gf0 AS MATERIALIZED (SELECT f.doc_id, f.leaf, g.h AS subroot, 0 AS grp, g.idx AS pos, f.proof, f.fold FROM df{depth} f JOIN g0 g ON f.grp IS NOT DISTINCT FROM g.lang),
{_fold_sql("g", groups_depth)}
SELECT f.doc_id, f.leaf, f.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, f.fold = r.h AS verified
FROM gf{groups_depth} f JOIN g{groups_depth} r ON f.grp = r.grp
"""


ORACLE = oracle()
