"""Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf: a digest of its fields.  The leaves of one group (``lang``), in order of their ids, make a tree of
``ARITY``-wise nodes; the groups' roots, in order of the groups, make the tree above.

Ranks are written as digits.  The lowest ``DEPTH`` digits place a node inside its block, the rest name the block, so a
block holds at most ``ARITY ** DEPTH`` nodes whatever the size of the group.  Inside a block the digit columns are
grouped away one after the other, lowest first; each step nests the children's structs in their parent's, and after the
last one the block is a single nested struct.  The blocks' roots are the next tier's nodes, until one block per group is
left.

Proofs go the other way.  Tiers are taken from the top: the path of a block (its siblings up to the root) meets the
block's nested struct in one grouping by block, ``transform`` carries the path down through the nested children, and
``explode`` returns one row per node; nothing is joined.

``levels`` in names counts digits; a node that is alone at the head of its group at some digit is what remains, and is
passed on without hashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.ordering import ranked
from pasture.llm.scratch import pick, stored

ARITY, DEPTH = 2, 10
FIELDS = {"doc_id": "bigint", "source": "string", "lang": "string", "n_chars": "bigint", "text": "string"}
_PATH = "array<struct<left:string,right:string>>"


def digest(parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts of an array, concatenated."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of one row: each field as its UTF-8 byte count, ``:`` and value, or ``-`` where it is null."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*(one(c) for c in fields.values())), 256)


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(grp, id, h, p): group, id, leaf, and in ``p`` the id, the leaf and the leaf after tampering.

    Tampering adds 1 to ``n_chars`` of the rows where ``changed`` holds; nulls stay.
    """
    d = pick(docs, **FIELDS)
    own = {c: F.col(c) for c in FIELDS}
    more = own | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    d = d.withColumns({"h": leaf(own), "t": leaf(own) if changed is None else F.when(changed, leaf(more))})
    return d.select(F.col("lang").alias("grp"), F.col("doc_id").alias("id"), "h",
                    F.struct(F.col("doc_id").alias("id"), F.col("h").alias("leaf"),
                             F.coalesce("t", "h").alias("tampered")).alias("p"))


def rollup(nodes: DataFrame, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """(grp, block, node) from (grp, rank, h, p): every block as one nested struct (h, kids, p).

    Exchanged once, by (grp, block): all groupings of digits keep that partitioning.
    """
    size = arity ** depth
    digits = [f"d{k}" for k in range(depth)]
    x = nodes.select("grp", F.expr(f"rank div {size}").alias("block"),
                     *(F.expr(f"cast(rank div {arity ** k} % {arity} as int)").alias(d) for k, d in enumerate(digits)),
                     F.struct("h", "p").alias("node")).repartition("grp", "block")
    for k, d in enumerate(digits):
        rest = digits[k + 1:]
        kids = F.sort_array(F.collect_list(F.struct(F.col(d).alias("digit"), F.col("node.h").alias("h"), "node")))
        x = x.groupBy("grp", "block", *rest).agg(F.transform(kids, lambda c: c["node"]).alias("kids"))
        head = F.col("block") == 0
        for r in rest:
            head = head & (F.col(r) == 0)
        alone = head & (F.size("kids") == 1)            # what remains of its group: not hashed again
        h = F.when(alone, F.col("kids")[0]["h"]).otherwise(digest(F.transform("kids", lambda c: c["h"])))
        x = x.select("grp", "block", *rest, F.struct(h.alias("h"), alone.alias("alone"), "kids").alias("node"))
    return x


def unroll(blocks: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(grp, rank, h, p, path, above) from (grp, block, node, path, above): one row per node of every block.

    ``path``: what stands left and right of the node and of those above it, upwards to the root; ``above`` is passed on.
    """
    def down(ns: Column) -> Column:
        def kids(n: Column) -> Column:
            own = n["node"]["kids"]
            hashes = F.transform(own, lambda c: c["h"])
            step = lambda i: F.when(n["node"]["alone"], F.array().cast(_PATH)).otherwise(F.array(F.struct(
                F.array_join(F.slice(hashes, 1, i), "").alias("left"),
                F.array_join(F.slice(hashes, i + 2, F.greatest(F.size(hashes) - i - 1, F.lit(0))), "").alias("right"))))
            return F.transform(own, lambda c, i: F.struct(c.alias("node"), F.concat(step(i), n["path"]).alias("path")))
        return F.flatten(F.transform(ns, kids))

    x = blocks.select("grp", "block", "above", F.array(F.struct("node", "path")).alias("ns"))
    for _ in range(depth):
        x = x.withColumn("ns", down(F.col("ns")))
    # leaves of a block stand in rank order without a gap
    x = x.select("grp", "block", "above", F.posexplode("ns").alias("at", "n"))
    return x.select("grp", "block", "at", F.col("n.node.h").alias("h"), F.col("n.node.p").alias("p"), "n.path", "above")


def _tiers(nodes: DataFrame, arity: int, depth: int) -> list[DataFrame]:
    """Blocks of every tier, lowest first; the last has one block per group."""
    tiers = []
    while True:
        tiers.append(stored(rollup(nodes, arity, depth), f"tier{len(tiers)}"))
        if tiers[-1].where("block > 0").isEmpty():
            return tiers
        nodes = tiers[-1].select("grp", F.col("block").alias("rank"), F.col("node.h").alias("h"), F.lit(None).cast("string").alias("p"))


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Every block with its path and what is passed on: one grouping by (grp, block), null being a group."""
    cols = ["node", "path", "above"]
    none = {c: F.lit(None).cast(t) for c, t in [*blocks.dtypes, *paths.dtypes] if c in cols}
    every = blocks.select("grp", "block", "node", none["path"].alias("path"), none["above"].alias("above")).unionByName(
        paths.select("grp", "block", none["node"].alias("node"), "path", "above"))
    return every.groupBy("grp", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in cols))


def _descend(tiers: list[DataFrame], paths: DataFrame, depth: int, size: int) -> DataFrame:
    """Nodes of the lowest tier with their paths, from the paths of the topmost blocks."""
    for k in range(len(tiers) - 1, -1, -1):
        found = unroll(_with_paths(tiers[k], paths), depth)
        if k == 0:
            return found
        rank = (F.col("block") * size + F.col("at")).alias("block")
        paths = stored(found.select("grp", rank, "path", "above"), f"paths{k}")
    raise AssertionError("no tier")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame, changed: Column | None = None, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, tampered, subroot, root, path) per row of ``docs`` (doc_id, source, lang, n_chars, text).

    Groups are languages, null among them (first of all); rows stand by doc_id, null first, then by leaf, so rows that
    are equal in all fields are interchangeable.  Null fields count as ``-``, an empty text as ``0:``.  ``path``: left
    and right siblings level by level, through the group's root to the root.  A single row is its own subroot and root,
    with an empty path; an empty table has no rows.
    """
    size = arity ** depth
    slim = stored(leaves(docs, changed), "leaves")
    tiers = _tiers(ranked(slim, "grp", ["id", "h"], "ranks").select("grp", "rank", "h", "p"), arity, depth)
    tops = stored(tiers[-1].select(F.lit(0).alias("one"), "grp", F.col("node.h").alias("h")), "subroots")
    groups = ranked(tops, "one", ["grp"], "subroot_ranks")
    groups = _tiers(groups.select(F.col("one").alias("grp"), "rank", "h", F.struct(F.col("grp").alias("grp"),
                                                                                  F.col("h").alias("subroot")).alias("p")), arity, depth)
    top = groups[-1].select("grp", "block", F.array().cast(_PATH).alias("path"), F.col("node.h").alias("above"))
    paths = _descend(groups, top, depth, size).select(
        F.col("p.grp").alias("grp"), F.lit(0).cast("bigint").alias("block"), "path",
        F.struct(F.col("p.subroot").alias("subroot"), F.col("above").alias("root")).alias("above"))
    found = _descend(tiers, stored(paths, "subroot_paths"), depth, size)
    return found.select(F.col("p.id").alias("doc_id"), "p.leaf", "p.tampered", "above.subroot", "above.root", "path")


def tampered_row(every: int = 7) -> Column:
    """Rows whose crc32 of the decimal doc_id ``every`` divides; never those without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))


def verified(docs: DataFrame, every: int = 7, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row checked against the root, after
    tampering with ``tampered_row``.  ``proof_sha256``: digest of the siblings, leaf level first, left to right."""
    m = manifest(docs, tampered_row(every), arity, depth)
    m = m.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    return m.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))


_CRC = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab)"""


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of an ASCII text; needs the table ``crc`` of ``_CRC`` beside it."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            f"lambda ch: ascii(ch)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]::BIGINT)))")


def oracle_sql(every: int = 7, levels: int = 40) -> str:
    """DuckDB SQL for ``verified(documents)`` with pairs; trees of up to 2 ** ``levels`` rows."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def row(**other: str) -> str:
        return "sha256(" + " || ".join(field(other.get(c, c)) for c in FIELDS) + ")"

    def tree(name: str, base: str) -> str:
        """Levels of the trees of ``base`` (grp, pos, h, n): n nodes are left at a level."""
        return f"""{name} AS (
  SELECT 0 AS lvl, grp, pos, h, n FROM {base}
  UNION ALL
  SELECT DISTINCT lvl + 1, grp, pos // 2, sha256(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY grp, pos // 2
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), (n + 1) // 2 FROM {name} WHERE n > 1 AND lvl < {levels})"""

    return f"""
WITH RECURSIVE {_CRC},
d AS (SELECT doc_id, lang, {row()} AS leaf, {row(n_chars='(n_chars::HUGEINT + 1)')} AS other,
             coalesce(({crc32_sql('doc_id::VARCHAR')}) % {every} = 0, false) AS hit FROM documents, crc),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
g AS (SELECT lang, row_number() OVER (ORDER BY lang COLLATE "binary" NULLS FIRST) - 1 AS grp, count(*) OVER () AS m
      FROM (SELECT DISTINCT lang FROM d)),
x AS (SELECT r.*, g.grp FROM r JOIN g ON r.lang IS NOT DISTINCT FROM g.lang),
base1 AS (SELECT grp, pos, leaf AS h, n FROM x),
{tree('t1', 'base1')},
top1 AS (SELECT grp, h AS subroot FROM t1 WHERE n = 1),
base2 AS (SELECT 0 AS grp, top1.grp AS pos, subroot AS h, m AS n FROM top1 JOIN g USING (grp)),
{tree('t2', 'base2')},
top2 AS (SELECT h AS root FROM t2 WHERE n = 1),
walk AS (
  SELECT doc_id, leaf, pos AS rid, grp, 1 AS part, 0 AS lvl, pos AS at, CASE WHEN hit THEN other ELSE leaf END AS f, '' AS proof FROM x
  UNION ALL
  SELECT w.doc_id, w.leaf, w.rid, w.grp, CASE WHEN a.n = 1 THEN 2 ELSE w.part END, CASE WHEN a.n = 1 THEN 0 ELSE w.lvl + 1 END,
         CASE WHEN a.n = 1 THEN w.grp ELSE w.at // 2 END,
         CASE WHEN a.n = 1 THEN w.f WHEN w.at % 2 = 1 THEN sha256(s.h || w.f) ELSE sha256(w.f || coalesce(s.h, '')) END,
         w.proof || CASE WHEN a.n = 1 THEN '' ELSE coalesce(s.h, '') END
  FROM walk w
  JOIN (SELECT 1 AS part, lvl, grp, pos, n FROM t1 UNION ALL SELECT 2, lvl, grp, pos, n FROM t2) a
    ON a.part = w.part AND a.lvl = w.lvl AND a.pos = w.at AND a.grp = CASE WHEN w.part = 1 THEN w.grp ELSE 0 END
  LEFT JOIN (SELECT 1 AS part, lvl, grp, pos, h FROM t1 UNION ALL SELECT 2, lvl, grp, pos, h FROM t2) s
    ON s.part = w.part AND s.lvl = w.lvl AND s.pos = xor(w.at, 1) AND s.grp = CASE WHEN w.part = 1 THEN w.grp ELSE 0 END
  WHERE w.part = 1 OR a.n > 1),
ended AS (SELECT w.* FROM walk w JOIN t2 ON w.part = 2 AND t2.lvl = w.lvl AND t2.n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM ended JOIN top1 USING (grp), top2
"""
