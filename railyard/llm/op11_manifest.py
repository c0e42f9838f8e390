"""Merkle manifest of a dataset: lag and lead windows supply siblings, first children hash parents.

Each row is a leaf, the SHA-256 of its columns. Leaves of one source are ordered by id; every ``FAN`` consecutive nodes
become their parent until one is left, the source's subroot; the subroots, ordered by source, become the root in the
same way. A level is one table of (grp, place, size, hash). Within blocks of whole runs, ``lag`` and ``lead`` columns
at the fixed offsets 1 .. FAN - 1, masked by the slot in the run and the run's length, hold a node's siblings; rows in
slot 0 hash themselves and their ``lead`` columns to the parent. So no run, source or level is in one task: a block has
at most ``BLOCK`` nodes, and places come from ``order.placed``.

Proofs go down the same levels: a node's path is its own siblings and its parent's path, and what hangs over a source
(the path from subroot to root) enters at the subroot, so that no row is ever joined by its source alone.

NULL columns hash as ``-``, distinct from empty texts (``0:``). NULL ids come first, NULL sources form one source that
comes first. Rows of equal id in a source follow by leaf; fully repeated rows are leaves each. A long text is hashed
whole and does not travel further. An empty table has no root and gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm import order, sql, tables

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
BLOCK = FAN * 256
TAMPER = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(columns: list[Column]) -> Column:
    texts = [c.cast("string") for c in columns]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def run_of(fan: int) -> Column:
    return F.expr(f"place div {fan}")


def siblings(nodes: DataFrame, fan: int = FAN, sides: tuple[str, ...] = ("left", "right")) -> DataFrame:
    """``nodes`` with the joined hashes of a node's siblings before it (``left``) and after it (``right``)."""
    block = Window.partitionBy("grp", F.expr(f"place div {fan * (BLOCK // FAN)}")).orderBy("place")
    slot = F.expr(f"place % {fan}")
    length = F.least(F.lit(fan), F.col("size") - (F.col("place") - slot))
    none = F.lit("")
    made = {
        "left": F.concat(*(F.when(slot >= k, F.lag("hash", k).over(block)).otherwise(none) for k in range(fan - 1, 0, -1))),
        "right": F.concat(*(F.when(slot + k < length, F.lead("hash", k).over(block)).otherwise(none) for k in range(1, fan))),
    }
    return nodes.withColumns({side: made[side] for side in sides})


def parents(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """The next level of all groups of more than one node."""
    first = siblings(nodes.filter("size > 1").select("grp", "place", "size", "hash"), fan, ("right",)).filter(f"place % {fan} = 0")
    return first.select("grp", run_of(fan).alias("place"), F.expr(f"(size + {fan - 1}) div {fan}").alias("size"), digest(F.col("hash"), F.col("right")).alias("hash"))


def levels(nodes: DataFrame, fan: int, label: str) -> list[DataFrame]:
    """``nodes`` and the levels above; a group is absent above its root, which has size 1. Each level is 1/fan of the
    one below and written; how many there are is the logarithm of the largest group."""
    found = [nodes]
    left = nodes.agg(F.max("size")).first()[0] or 0
    while left > 1:
        found.append(tables.written(parents(found[-1], fan), f"{label}-{len(found)}"))
        left = -(-left // fan)
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """(grp, hash): the root of each group."""
    return reduce(DataFrame.unionByName, [level.filter("size = 1").select("grp", "hash") for level in found])


def paths(found: list[DataFrame], above: DataFrame, fan: int, label: str) -> DataFrame:
    """The lowest level with ``path``, the siblings up to the root, and the columns of ``above`` (grp, path, ...)."""
    kept = [c for c in above.columns if c != "grp"]
    upper: DataFrame | None = None
    for k in range(len(found) - 1, -1, -1):
        level = found[k]
        here = level.filter("size = 1").join(above, "grp")
        if upper is not None:
            higher = upper.select(F.col("grp"), F.col("place").alias("run"), *kept)
            near = siblings(level.filter("size > 1"), fan).withColumn("run", run_of(fan)).join(higher, ["grp", "run"])
            near = near.withColumn("path", F.concat(F.array(F.struct("left", "right")), F.col("path")))
            here = here.unionByName(near.select(*here.columns))
        upper = here if k == 0 else tables.written(here, f"{label}-path-{k}")
    return upper


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


class Manifest:
    """``root``; ``sources`` and ``documents``: their levels, from the leaves up."""

    def __init__(self, documents: list[DataFrame], sources: list[DataFrame], root: str | None, fan: int):
        self.documents, self.sources, self.root, self.fan = documents, sources, root, fan

    def nodes(self) -> DataFrame:
        """All nodes as (tree, level, grp, place, hash); ``grp`` is '0' for the NULL source, else '1' and the source."""
        parts = [
            level.select(F.lit(tree).alias("tree"), F.lit(k).alias("level"), "grp", "place", "hash")
            for tree, found in (("documents", self.documents), ("sources", self.sources))
            for k, level in enumerate(found)
        ]
        return reduce(DataFrame.unionByName, parts)

    def proofs(self) -> DataFrame:
        """Per leaf: key, carried columns, hash, subroot, path (array of left and right siblings, leaf to root)."""
        empty = F.array().cast("array<struct<left:string,right:string>>")
        over = self.sources[0].select("grp").limit(1).withColumn("path", empty)
        by_source = paths(self.sources, over, self.fan, "sources")
        above = by_source.select(F.col("source").alias("grp"), F.col("hash").alias("subroot"), "path")
        return paths(self.documents, tables.written(above, "above"), self.fan, "documents")


def build(
    docs: DataFrame, columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", group: str = "source", fan: int = FAN, carry: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of all rows of ``docs``. ``carry`` adds columns, made from ``docs``, to the leaves."""
    source = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(
        source.alias("grp"), F.col(key).alias("key"), leaf_of([F.col(c) for c in columns]).alias("hash"),
        *(made.alias(name) for name, made in (carry or {}).items()),
    )
    leaves = order.placed(tables.written(rows, "leaves"), "grp", ["key", "hash"], "places")
    documents = levels(leaves, fan, "documents")
    subroots = tops(documents).select(F.lit("").alias("grp"), F.col("grp").alias("source"), "hash")
    sources = levels(order.placed(tables.written(subroots, "subroots"), "grp", ["source"], "sources"), fan, "sources")
    top = sources[-1].filter("size = 1").select("hash").first()
    return Manifest(documents, sources, top and top["hash"], fan)


def audit(docs: DataFrame, changed: Column, **options) -> DataFrame:
    """Proves, per row, a leaf against the manifest of ``docs``: ``changed`` is the leaf found later, NULL if as before."""
    made = build(docs, carry={"changed": changed}, **options)
    rows = made.proofs().withColumn("root", F.lit(made.root).cast("string"))
    whole = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    rows = rows.withColumns({"proof_sha256": F.sha2(whole, 256), "folded_root": folded(F.coalesce("changed", "hash"), F.col("path"))})
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    after = leaf_of([F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in COLUMNS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    found = audit(docs, F.when(hit, after))
    return found.select(F.col("key").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")


def _oracle(depth: int = 6) -> str:
    """Plain SQL for sources of up to 16**depth rows, and as many sources."""

    def field(column: str) -> str:
        return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"

    def tree(first: str, name: str) -> list[str]:
        steps = [f"{name}_0 AS ({first})"]
        for k in range(depth):
            # one row per node with its run; groups of one node stay as they are
            steps.append(
                f"{name}_run_{k} AS (SELECT grp, place, size, place // {FAN} AS run, place % {FAN} AS slot, list(h) OVER (PARTITION BY grp, place // {FAN} "
                f"ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS hs FROM {name}_{k})"
            )
            steps.append(
                f"{name}_{k + 1} AS (SELECT grp, run AS place, (size + {FAN - 1}) // {FAN} AS size, "
                f"CASE WHEN size > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}_run_{k} WHERE slot = 0)"
            )
        return steps

    def fold(name: str, first: str, key: str) -> list[str]:
        steps = [f"{name}_fold_0 AS ({first})"]
        for k in range(depth):
            left, right = "array_to_string(r.hs[1:r.slot], '')", "array_to_string(r.hs[r.slot + 2:], '')"
            steps.append(
                f"{name}_fold_{k + 1} AS (SELECT f.* REPLACE (CASE WHEN r.size > 1 THEN sha256({left} || f.fold || {right}) ELSE f.fold END AS fold, "
                f"f.place // {FAN} AS place, f.proof || CASE WHEN r.size > 1 THEN {left} || {right} ELSE '' END AS proof) "
                f"FROM {name}_fold_{k} f JOIN {name}_run_{k} r ON r.grp = f.{key} AND r.place = f.place)"
            )
        return steps

    leaf = " || ".join(field(c) for c in COLUMNS)
    changed = leaf.replace(field("text"), field(f"translate(text, '{_UPPER}', '{_LOWER}')"))
    steps = [
        sql.CRC32,
        "rows AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, sha256(" + leaf + ") AS h, "
        f"CASE WHEN {sql.crc32('doc_id::VARCHAR')} % {TAMPER} = 0 THEN sha256(" + changed + ") END AS changed FROM documents, crc_bytes)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY grp) AS size FROM rows)",
        *tree("SELECT grp, place, size, h FROM leaves", "doc"),
        f"tops AS (SELECT grp AS source, h, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS size FROM doc_{depth})",
        *tree("SELECT '' AS grp, place, size, h FROM tops", "src"),
        *fold("doc", "SELECT doc_id, grp, place, h, coalesce(changed, h) AS fold, '' AS proof FROM leaves", "grp"),
        *fold("src", f"SELECT f.doc_id, f.grp, t.place, f.h, f.fold, f.proof, '' AS one, t.h AS subroot FROM doc_fold_{depth} f JOIN tops t ON t.source = f.grp", "one"),
    ]
    return (
        "WITH " + ", ".join(steps) + " SELECT f.doc_id, f.h AS leaf, f.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.fold AS folded_root, "
        f"f.fold = r.h AS verified FROM src_fold_{depth} f, src_{depth} r"
    )


ORACLE = _oracle()
