"""A Merkle manifest of a dataset: one tree per source, and a tree over the sources.

Rows become leaves, numbered in their source by id. ``SUPERBLOCK`` neighbouring
leaves of a source are a superblock. Upwards, each superblock is reduced by its own
group to one node, and the nodes are numbered, cut and reduced in the same way until
a source has one; subroots form a last tree in the order of their sources. Downwards,
the nodes and the outer siblings above their superblock are cogrouped by superblock
in ``applyInPandas``. That one pass repeats the local reduction, joins the local to
the outer part of each proof, and folds the proofs. A large source, or very many
sources, make more superblocks, not larger ones, and the outer part of a proof is
stored once per superblock.

Leaves are placed by a range partitioning on source, id and leaf with counts per
partition, so no source is ever sorted or counted in one task.

Cases: an empty table gives an empty result; a null source is a source of its own,
before all others; null ids come first in their source, equal ids are ordered by
leaf, and equal rows are leaves of their own; a null id is never tampered with; nulls
and empty strings have different leaves; a text of any length is one leaf; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventmere.llm import shared

ARITY = 16
#: Levels that a superblock is reduced by at once.
LEVELS = 3
SUPERBLOCK = ARITY**LEVELS
#: Leaves that one task of the exchange should hold, in some whole superblocks.
TASK_LEAVES = 4 * SUPERBLOCK

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE_DDL = "tree string, pos long, total long, node string"
PATH_DDL = "tree string, pos long, lefts array<string>, rights array<string>"
PROOF_DDL = (
    "doc string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(*fields: Column) -> Column:
    """The hash of a row's fields, each ``-`` or its byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame, key: str, source: str, fields: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """``tree``, ``doc``, ``leaf``, and ``other``: the leaf with some fields changed, if it differs."""
    docs = docs.select(*dict.fromkeys([key, source, *fields]))
    kept = [F.col(f) for f in fields]
    leaf = leaf_hash(*kept)
    tampered = leaf_hash(*[(changed or {}).get(f, F.col(f)) for f in fields])
    rows = docs.select(
        # Sorts like the sources, null first, and is never null itself.
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("tree"),
        F.col(key).alias("key"),
        leaf.alias("leaf"),
        (tampered if changed else F.lit(None).cast("string")).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn("other", F.when(F.col("other") != F.col("leaf"), F.col("other")))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``pos`` in the tree and ``total`` of the tree, both counted over range partitions."""
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # The id holds the partition in its upper and the row in its lower 33 bits.
    placed = shared.stored(placed.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part, row = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_row": row})
    # A tree has one line per partition it reaches into.
    runs = placed.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        tree, "_part", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("total"),
    )
    found = placed.join(runs, [tree, "_part"]).withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before"))
    return found.drop("_at", "_part", "_row", "_first", "_before")


def _reduced(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of one superblock, from its nodes up to its single top."""
    levels = [nodes]
    while len(levels[-1]) > 1 if total <= SUPERBLOCK else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def _siblings(level: list[str], at: int) -> tuple[str, str]:
    run = at - at % ARITY
    return "".join(level[run:at]), "".join(level[at + 1 : run + ARITY])


def _superblocks(table: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """The superblocks of a group, each with its tree, number and nodes in order."""
    if len(table):
        table = table.sort_values(["tree", "pos"], kind="stable")
        for (tree, number), block in table.groupby(["tree", table["pos"] // SUPERBLOCK], sort=False):
            yield tree, int(number), block


def by_superblock(nodes: DataFrame, count: int, superblock: Column | None = None) -> DataFrame:
    """Deal superblocks out to ``group``s of about one each, some groups to a task."""
    groups = max(1, -(-count // SUPERBLOCK))
    number = F.expr(f"pos div {SUPERBLOCK}") if superblock is None else superblock
    tasks = max(1, min(-(-count // TASK_LEAVES), max(shared.shuffle_partitions(nodes.sparkSession), count // 1_000_000)))
    return nodes.withColumn("group", F.pmod(F.xxhash64("tree", number), F.lit(groups))).repartition(tasks, "group")


def reduce_once(nodes: DataFrame, count: int) -> DataFrame:
    """Each superblock as one node of the next round."""

    def reduce(table: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for tree, number, block in _superblocks(table):
            total = int(block["total"].iloc[0])
            rows.append((tree, number, -(-total // SUPERBLOCK), _reduced(block["node"].tolist(), total)[-1][0]))
        return pd.DataFrame(rows, columns=["tree", "pos", "total", "node"])

    dealt = by_superblock(nodes.select("tree", "pos", "total", "node"), count)
    return shared.stored(dealt.groupBy("group").applyInPandas(reduce, NODE_DDL), "merkle-nodes")


def rounds(nodes: DataFrame, count: int) -> list[tuple[DataFrame, int]]:
    """The nodes of every round and their number; in the last, each tree has one node."""
    found = [(nodes, count)]
    while True:
        nodes, before = found[-1]
        now = reduce_once(nodes, before)
        size, most = now.agg(F.count("*"), F.coalesce(F.max("total"), F.lit(0))).first()
        found.append((now, size))
        if most <= 1:
            return found


def _outer(paths: pd.DataFrame) -> dict[tuple[str, int], tuple[list[str], list[str]]]:
    """Siblings above each superblock, by its tree and number."""
    return {(t, int(p)): (list(a), list(b)) for t, p, a, b in zip(paths["tree"], paths["pos"], paths["lefts"], paths["rights"])}


def paths_below(nodes: DataFrame, count: int, outer: DataFrame) -> DataFrame:
    """Siblings of every node on its way to the root: lists from the lowest level up."""

    def expand(table: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        known, rows = _outer(above), []
        for tree, number, block in _superblocks(table):
            levels = _reduced(block["node"].tolist(), int(block["total"].iloc[0]))
            lefts, rights = known[tree, number]
            for i, pos in enumerate(block["pos"].tolist()):
                own = [_siblings(level, i // ARITY**n) for n, level in enumerate(levels[:-1])]
                rows.append((tree, pos, [p[0] for p in own] + lefts, [p[1] for p in own] + rights))
        return pd.DataFrame(rows, columns=["tree", "pos", "lefts", "rights"])

    dealt = by_superblock(nodes.select("tree", "pos", "total", "node"), count)
    asked = by_superblock(outer.select("tree", "pos", "lefts", "rights"), count, F.col("pos"))
    found = dealt.groupBy("group").cogroup(asked.groupBy("group")).applyInPandas(expand, PATH_DDL)
    return shared.stored(found, "merkle-paths")


class _Climber:
    """Proofs and folds in one superblock; what many leaves share is worked out once."""

    def __init__(self, levels: list[list[str]], lefts: list[str], rights: list[str]):
        self.levels, self.above = levels, list(zip(lefts, rights))
        self.sides = [[_siblings(level, i) for i in range(len(level))] for level in levels[:-1]]
        # The proof from a level on, siblings left to right, for each node of the level.
        self.proofs = [["".join(a + b for a, b in self.above)]]
        for sides in reversed(self.sides):
            up = self.proofs[0]
            self.proofs.insert(0, [a + b + up[i // ARITY] for i, (a, b) in enumerate(sides)])
        self.known: dict[tuple[int, int, str], str] = {}

    def proof(self, at: int) -> str:
        return digest(self.proofs[0][at])

    def fold(self, value: str, at: int, level: int = 0) -> str:
        """The root that a node value leads to, hashed with its siblings level by level."""
        if level == len(self.sides):
            for left, right in self.above:
                value = digest(left + value + right)
            return value
        if level and (level, at, value) in self.known:
            return self.known[level, at, value]
        left, right = self.sides[level][at]
        found = self.fold(digest(left + value + right), at // ARITY, level + 1)
        if level:
            self.known[level, at, value] = found
        return found


def prove(placed: DataFrame, count: int, outer: DataFrame) -> DataFrame:
    """The leaves with their proofs, and the roots their proofs fold to."""

    def finish(table: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        known = _outer(above)
        roots = {t: (s, r) for t, s, r in zip(above["tree"], above["subroot"], above["root"])}
        rows = []
        for tree, number, block in _superblocks(table):
            nodes = block["node"].tolist()
            climber = _Climber(_reduced(nodes, int(block["total"].iloc[0])), *known[tree, number])
            subroot, root = roots[tree]
            for i, (doc, leaf, other) in enumerate(zip(block["doc"], nodes, block["other"])):
                folded = climber.fold(leaf if other is None else other, i)
                rows.append((doc, leaf, subroot, root, climber.proof(i), folded, folded == root))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in PROOF_DDL.split(", ")])

    dealt = by_superblock(placed.select("tree", "pos", "total", "node", "doc", "other"), count)
    asked = by_superblock(outer.select("tree", "pos", "lefts", "rights", "subroot", "root"), count, F.col("pos"))
    return dealt.groupBy("group").cogroup(asked.groupBy("group")).applyInPandas(finish, PROOF_DDL)


def _lowest(found: list[tuple[DataFrame, int]], outer: DataFrame) -> DataFrame:
    """From the siblings above each tree's single node down to those above the lowest superblocks."""
    for nodes, count in reversed(found[1:-1]):
        outer = paths_below(nodes, count, outer)
    return outer


def manifest(
    docs: DataFrame, key: str = "doc_id", source: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``changed`` names what stands in some fields when the proofs are folded again;
    roots and proofs are always those of the rows as they are.
    """
    made = shared.stored(leaves(docs, key, source, list(fields), changed), "merkle-leaves")
    key_type = docs.schema[key].dataType
    # As text, which pandas keeps whole beside nulls.
    placed = numbered(made, "tree", ["key", "leaf", "row"]).select(
        "tree", "pos", "total", F.col("leaf").alias("node"), F.col("key").cast("string").alias("doc"), "other"
    )
    placed = shared.stored(placed, "merkle-placed")
    count = placed.count()
    own = rounds(placed, count)

    # Subroots by source are the leaves of one more tree.
    subroots = own[-1][0].select(F.col("tree").alias("name"), "node").withColumn("tree", F.lit("root"))
    tops = shared.stored(numbered(subroots, "tree", ["name"]), "merkle-subroots")
    over = rounds(tops, own[-1][1])
    nothing = F.array().cast("array<string>")
    top = over[-1][0].first()
    root = F.lit(top["node"] if top else None).cast("string").alias("root")
    outer = _lowest(over, over[-1][0].select("tree", "pos", nothing.alias("lefts"), nothing.alias("rights")))
    outer = paths_below(*over[0], outer).join(tops.select("pos", "name", F.col("node").alias("subroot")), "pos")
    sources = shared.stored(outer.select(F.col("name").alias("tree"), "subroot", root, "lefts", "rights"), "merkle-sources")

    above = _lowest(own, sources.select("tree", F.lit(0).cast("long").alias("pos"), "lefts", "rights"))
    above = above.join(sources.select("tree", "subroot", "root"), "tree")
    proved = prove(placed, count, above)
    return proved.select(F.col("doc").cast(key_type).alias(key), *[F.col(c) for c in proved.columns if c != "doc"])


def tampered_text(key: str = "doc_id", text: str = "text") -> Column:
    """The text, A-Z in lower case where 5 divides the crc32 of the decimal id."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(F.col(text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    return manifest(docs, changed={"text": tampered_text()})


#: Levels that the SQL spells out: up to 16**5 leaves a source, and as many sources.
SQL_LEVELS = 5


def _sql() -> str:
    field = lambda f: f"coalesce(octet_length(encode({f}::VARCHAR))::VARCHAR || ':' || {f}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    steps = [
        f"""d AS (
  SELECT *, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT] || list_transform(range(8), lambda i: -1::BIGINT))),
    lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT) AS crc
  FROM documents
), l AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
    {leaf(f"(CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END)")} AS used
  FROM d
), a0 AS (
  SELECT *, coalesce('s' || source, 'n') AS tree, leaf AS node, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM l
)"""
    ]

    def tree(name: str) -> None:
        for n in range(SQL_LEVELS):
            steps.append(
                f"""{name}{n}s AS (
  SELECT tree, pos, node, count(*) OVER (PARTITION BY tree) AS total,
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
    coalesce(string_agg(node, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
  FROM {name}{n} WINDOW r AS (PARTITION BY tree, pos // {ARITY} ORDER BY pos)
), {name}{n + 1} AS (
  SELECT tree, pos // {ARITY} AS pos, CASE WHEN any_value(total) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
  FROM {name}{n}s GROUP BY tree, pos // {ARITY}
)"""
            )

    def climb(start: str, name: str) -> str:
        """Proof and fold through the levels of one tree, one step each."""
        now = start
        for n in range(SQL_LEVELS):
            place = f"pos // {ARITY**n}"
            steps.append(
                f"""{name}{n}c AS (
  SELECT c.* EXCLUDE (proof, fold), proof || s.lefts || s.rights AS proof,
    CASE WHEN s.total = 1 THEN fold ELSE sha256(s.lefts || fold || s.rights) END AS fold
  FROM {now} c JOIN {name}{n}s s ON s.tree = c.tree AND s.pos = c.{place}
)"""
            )
            now = f"{name}{n}c"
        return now

    tree("a")
    steps.append(
        f"b0 AS (SELECT 'root' AS tree, tree AS name, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM a{SQL_LEVELS})"
    )
    tree("b")
    steps.append("p AS (SELECT doc_id, leaf, tree, pos, '' AS proof, used AS fold FROM a0)")
    low = climb("p", "a")
    steps.append(
        f"q AS (SELECT c.doc_id, c.leaf, b0.tree, b0.pos, b0.node AS subroot, proof, fold FROM {low} c JOIN b0 ON b0.name = c.tree)"
    )
    high = climb("q", "b")
    return (
        "WITH " + ", ".join(steps) + f"""
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.node AS verified
FROM {high} c JOIN b{SQL_LEVELS} t ON t.tree = c.tree
"""
    )


ORACLE_SQL = _sql()
