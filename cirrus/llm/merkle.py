"""Merkle manifest of a dataset: a hash tree for each group of rows, one over all.

A leaf is the SHA-256 of a row's fields.  The leaves of a group stand in the
order of their key; every two neighbours become the hash of their joined hex
texts (a last single one is hashed alone) until one node, the group's subroot,
remains.  The subroots, in the order of their group, go on in the same way to
the root.

Nodes are held in aligned blocks of ``2**bits``.  A block keeps each level of
its subtree as one string of 64 hex digits a node, so that a parent is the hash
of a substring 128 wide and a sibling is the substring 64 wide beside a node.
The top nodes of the blocks are the nodes of the next round.  Positions come
from a range shuffle, so a group of any size is spread over tasks, and no task
ever holds more than a block of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, ranked, sized

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 8  # nodes of a block: 2**8, so a block's levels are at most 33 KB


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values: ``-`` for null, else byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves: the least h with 2**h >= n."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


# The block's levels, lowest first: k strings above that of its nodes.
_LEVELS = """
aggregate(slice(sequence(1, {bits}), 1, k), array(concat_ws('', transform(items, x -> x.node))),
  (levels, i) -> concat(levels, array(concat_ws('', transform(
    sequence(0, (length(element_at(levels, -1)) div 64 + 1) div 2 - 1),
    j -> sha2(substring(element_at(levels, -1), cast(128 * j + 1 as int), 128), 256))))))"""

# A node's siblings inside its block, lowest first: L or R (the side it is on)
# and its hash, or O where the node is alone.
_SEGMENT = """
transform(slice(sequence(0, {bits} - 1), 1, k), i -> CASE
  WHEN shiftright(x.pos & {mask}, i) % 2 = 1
    THEN concat('L', substring(levels[i], cast(64 * shiftright(x.pos & {mask}, i) - 63 as int), 64))
  WHEN length(levels[i]) > 64 * (shiftright(x.pos & {mask}, i) + 1)
    THEN concat('R', substring(levels[i], cast(64 * shiftright(x.pos & {mask}, i) + 65 as int), 64))
  ELSE 'O' END)"""


@dataclass
class Forest:
    """Blocks by round (columns g, block, h, k, items, levels) of one tree a group."""

    rounds: list[DataFrame]
    bits: int

    def roots(self) -> DataFrame:
        """g and top: the last node of each group."""
        done = [b.where(f"h <= {self.bits}").select("g", F.element_at("levels", -1).alias("top")) for b in self.rounds]
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return out

    def paths(self, tails: DataFrame) -> DataFrame:
        """Every node of the lowest round: g, pos, node, rest and ``path``, its
        siblings up to its group's top followed by the group's ``tail``
        (``tails``: g, tail; one row a group)."""
        segment = _SEGMENT.format(bits=self.bits, mask=2**self.bits - 1)
        below = None  # path of each block's top node: g, block, tail
        out = None
        for n in reversed(range(len(self.rounds))):
            blocks = self.rounds[n]
            last = blocks.where(f"h <= {self.bits}").join(tails, "g")
            if below is not None:
                more = blocks.where(f"h > {self.bits}").join(below, ["g", "block"])
                last = last.unionByName(more)
            out = last.selectExpr(
                "g",
                f"inline(transform(items, x -> named_struct('pos', x.pos, 'node', x.node, 'rest', x.rest, 'path', concat({segment}, tail))))",
            )
            if n:
                below = sized(cut(out.select("g", F.col("pos").alias("block"), F.col("path").alias("tail"))), 4096)
        return out


def grow(nodes: DataFrame, bits: int = BLOCK_BITS) -> Forest:
    """Trees over ``nodes``: g (group), pos (0-based, without gaps), node (hex),
    h (height of the group's tree) and rest (carried along)."""
    top = nodes.agg(F.max("h")).first()[0]
    rounds = []
    for _ in range(max(1, -(-(top or 0) // bits))):
        blocks = nodes.groupBy("g", F.shiftright("pos", bits).alias("block")).agg(
            F.first("h").alias("h"),
            F.array_sort(F.collect_list(F.struct("pos", "node", "rest"))).alias("items"),
        )
        blocks = blocks.withColumn("k", F.least(F.col("h"), F.lit(bits)))
        blocks = cut(blocks.withColumn("levels", F.expr(_LEVELS.format(bits=bits))))
        rounds.append(blocks)
        nodes = blocks.where(F.col("h") > bits).select(
            "g",
            F.col("block").alias("pos"),
            F.element_at("levels", -1).alias("node"),
            (F.col("h") - bits).alias("h"),
            F.lit(None).cast("int").alias("rest"),
        )
    return Forest(rounds, bits)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to."""

    def parent(node, sibling):
        side, other = F.substring(sibling, 1, 1), F.substring(sibling, 2, 64)
        return F.sha2(F.when(side == "R", F.concat(node, other)).when(side == "L", F.concat(other, node)).otherwise(node), 256)

    return F.aggregate(path, leaf, parent)


def proof_hash(path: Column) -> Column:
    """Hash of the siblings' joined hex texts (of the empty text if there are none)."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.substring(s, 2, 64))), 256)


def manifest(
    docs: DataFrame,
    claim: Column | None = None,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``group``, pos (place in the
    group), leaf, path (siblings from the leaf to the root, each L or R and its
    hash, or O where a node is alone), subroot, root and ``claim``, an optional
    expression over ``docs``.

    Rows of a group stand in the order of ``key`` (null first), equal keys in
    the order of their leaves, so repeated rows keep a place each and the result
    does not depend on how the input is split.  A null group is a group of its
    own, the first.  Null and empty fields have different leaves.  An empty
    table gives no rows.  Columns other than ``fields`` are left alone.
    """
    claim = F.lit(None).cast("string") if claim is None else claim
    rows = cut(
        docs.select(
            F.col(group).alias("grp"),
            F.col(key).alias("key"),
            leaf_hash([F.col(f) for f in fields]).alias("node"),
            claim.alias("claim"),
        )
    )
    sizes = cut(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    groups = cut(ranked(sizes, ["grp"], rank="g").select("grp", "g", _height(F.col("n")).alias("h")))
    placed = ranked(rows, ["grp", "key", "node"], ["grp"], rank="pos", per_group=groups)
    trees = grow(placed.select("g", "pos", "node", "h", F.struct("grp", "key", "claim").alias("rest")), bits)

    subroots = cut(trees.roots())
    over = subroots.select(
        F.lit(0).alias("g"),
        F.col("g").alias("pos"),
        F.col("top").alias("node"),
        _height(F.lit(subroots.count())).alias("h"),
        F.struct(F.col("top").alias("subroot")).alias("rest"),
    )
    above = grow(over, bits)
    root = above.roots().select("g", F.col("top").alias("root"), F.array().cast("array<string>").alias("tail"))
    root = F.broadcast(root)  # one row
    ways = above.paths(root.select("g", "tail")).join(root.select("g", "root"), "g")
    tails = cut(ways.select(F.col("pos").alias("g"), F.col("path").alias("tail"), "rest.subroot", "root"))
    tails = sized(tails, 2048)
    leaves = trees.paths(tails.select("g", "tail")).join(tails.select("g", "subroot", "root"), "g")
    return leaves.select(
        F.col("rest.key").alias(key),
        F.col("rest.grp").alias(group),
        "pos",
        F.col("node").alias("leaf"),
        "path",
        "subroot",
        "root",
        F.col("rest.claim").alias("claim"),
    )


def tampered(doc_id: Column) -> Column:
    """Whether the check alters this row; a null id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def verified_documents(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Manifest of ``documents`` and, for each row, the root that it leads to
    after some rows had 1 added to n_chars (null stays null).

    Only a row whose n_chars changed fails.  Nulls, repeated rows, ties and
    empty tables: see :func:`manifest`.
    """
    other = [F.col(f) if f != "n_chars" else F.col(f).cast("decimal(38,0)") + 1 for f in FIELDS]
    altered = F.when(tampered(F.col("doc_id")) & F.col("n_chars").isNotNull(), leaf_hash(other))
    out = manifest(docs, altered, bits=bits)
    out = out.withColumn("folded_root", fold(F.coalesce("claim", "leaf"), F.col("path")))
    return out.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# crc32 of a decimal text in DuckDB, bit by bit.
def crc32_duck(text: str) -> str:
    return f"""xor(list_reduce(list_transform(range(length({text})), lambda i: ascii(substr({text}, i::INT + 1, 1))::UBIGINT),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)::UBIGINT[]),
        lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END),
      4294967295::UBIGINT), 4294967295::UBIGINT)"""


def _field_duck(v: str) -> str:
    return f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')"


def _leaf_duck(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_duck(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_leaf_duck("n_chars")} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {crc32_duck("doc_id::VARCHAR")} % 7 = 0
              THEN {_leaf_duck("(n_chars::HUGEINT + 1)")} END AS altered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         row_number() OVER () AS id
  FROM leaves),
tree(g, lvl, pos, h) AS (
  SELECT g, 0, pos, leaf FROM placed
  UNION ALL
  SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM tree) WHERE n > 1 GROUP BY g, lvl, pos // 2),
subroots AS (SELECT g, max(lvl) AS height, arg_max(h, lvl) AS subroot FROM tree GROUP BY g),
over_tree(lvl, pos, h) AS (
  SELECT 0, g, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM over_tree) WHERE n > 1 GROUP BY lvl, pos // 2),
top AS (SELECT max(lvl) AS height, arg_max(h, lvl) AS root FROM over_tree),
steps AS (
  SELECT p.id, s.lvl::INT AS step, p.pos >> s.lvl AS place, t.h
  FROM placed p JOIN subroots r USING (g) CROSS JOIN LATERAL (SELECT unnest(range(r.height)) AS lvl) s
  LEFT JOIN tree t ON t.g = p.g AND t.lvl = s.lvl AND t.pos = xor(p.pos >> s.lvl, 1)
  UNION ALL
  SELECT p.id, (r.height + s.lvl)::INT, p.g >> s.lvl, t.h
  FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT unnest(range(height)) AS lvl FROM top) s
  LEFT JOIN over_tree t ON t.lvl = s.lvl AND t.pos = xor(p.g >> s.lvl, 1)),
proofs AS (SELECT id, string_agg(h, '' ORDER BY step) AS proof FROM steps GROUP BY id),
folded(id, step, node) AS (
  SELECT id, 0, coalesce(altered, leaf) FROM placed
  UNION ALL
  SELECT s.id, s.step + 1, sha256(CASE WHEN s.h IS NULL THEN f.node WHEN s.place % 2 = 0 THEN f.node || s.h ELSE s.h || f.node END)
  FROM folded f JOIN steps s ON s.id = f.id AND s.step = f.step),
ends AS (SELECT id, arg_max(node, step) AS folded_root FROM folded GROUP BY id)
SELECT p.doc_id, p.leaf, r.subroot, t.root, sha256(coalesce(f.proof, '')) AS proof_sha256, e.folded_root,
       e.folded_root = t.root AS verified
FROM placed p JOIN subroots r USING (g) CROSS JOIN top t LEFT JOIN proofs f USING (id) JOIN ends e USING (id)
"""
