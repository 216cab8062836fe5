"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Nodes.  Turns are digests of (role, text); a prefix's identity is a SHA-256 chain over its turns.  Chains run over
blocks of ``BLOCK`` turns; the digests of whole blocks are the items of the next level, so a conversation of any length
is hashed in many tasks, and ``prefixes`` calls itself some log(length) / log(BLOCK) times.  A node is known by its
smallest member and its depth from then on.

Totals.  A round first rakes: all childless nodes go, what they hold goes to their parents (sums, partly aggregated
before the shuffle).  Then it compresses: of neighbouring nodes with one child each, those go whose priority is the
least; their child hangs on their parent, and the edge remembers what was spliced out.  The priority is the number of
zeros that end the depth, then a hash of node and round, so a fresh chain halves every round.  Messages between
neighbours meet by key in three groupings per round; the tree is gone after some log(size) rounds, however deep it is.
Re-expansion takes the rounds backwards: a spliced node's total is its former child's total and what lay between.

Rounds are written to the shared folder; a lost executor repeats a part of one round.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.ordering import ranked
from pasture.llm.scratch import pick, stored

BLOCK = 256             # turns chained in one go
CHUNK = 1 << 14         # ids of one piece of a node's list of ends
HEAD = 3                # turns that a rebuilt conversation takes from another one, at most
ROOT = bytearray()
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _sha(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): every turn with its place in its conversation, from 1.

    Turns stand by ``turn`` (null first), then by their digest, so equal rows are interchangeable; each counts.  Null
    role or text is empty.  Rows without conv_id belong to no conversation and are left out.
    """
    c = pick(conversations, conv_id="bigint", turn="bigint", role="string", text="string").where("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    c = c.select("conv_id", "turn", _sha(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
                 F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("words"))
    c = ranked(stored(c, "turns"), "conv_id", ["turn", "digest"], "turn_ranks")
    return c.select("conv_id", (F.col("rank") + 1).alias("pos"), "digest", "words")


def rebuilt(placed: DataFrame, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """(c, len) of every conversation and (c, p, digest, words, last) of its rebuilt turns.

    Conversation c takes the first h turns of c - c % every (all if there are fewer), h = crc32(c) % 4, then its own
    after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    heads = placed.where(f"pos <= {HEAD} AND conv_id % {every} = 0").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))          # HEAD turns at most
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", h)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(heads, "base", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("h")))
    convs = convs.withColumn("len", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select(F.col("conv_id").alias("c"), "len", (F.col("h") - F.size("head")).alias("shift"), "head"), "convs")
    taken = convs.select("c", "len", F.explode("head").alias("x")).select("c", F.col("x.pos").alias("p"), "x.digest", "x.words", "len")
    own = placed.where(F.col("pos") > h).join(convs.select("c", "len", "shift"), F.col("conv_id") == F.col("c"))
    own = own.select("c", (F.col("pos") - F.col("shift")).alias("p"), "digest", "words", "len")
    rows = taken.unionByName(own).withColumn("last", F.col("p") == F.col("len")).drop("len")
    return convs.select("c", "len"), stored(rows, "rebuilt")


def _chained(batches, level: int):
    """Running digest within (c, k) of sorted rows, and the one before it."""
    seed = hashlib.sha256(b"level %d" % level).digest()
    at, state = None, None
    for b in batches:
        own, before = [], []
        for c, k, d in zip(*(b.column(x).to_pylist() for x in ("c", "k", "digest"))):
            if (c, k) != at:
                at, state = (c, k), None
            before.append(state)
            state = hashlib.sha256((state or seed) + d).digest()
            own.append(state)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.binary()), pa.array(before, pa.binary())],
                                         [*b.schema.names, "own", "before"])


def prefixes(items: DataFrame, block: int = BLOCK, level: int = 0) -> DataFrame:
    """``items`` (c, p, digest, …; p from 1 without gaps) with ``id`` and ``parent``: the identity of the prefix that
    ends here, and of the one before (the root's for p = 1).  Equal sequences have equal ids."""
    x = items.withColumn("k", F.expr(f"(p - 1) div {block}")).repartition("c", "k").sortWithinPartitions("c", "k", "p")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema.fields)
    x = stored(x.mapInArrow(lambda it: _chained(it, level), f"{fields}, own binary, before binary"), f"chains{level}")
    whole = x.where(F.col("p") % block == 0).select("c", (F.col("k") + 1).alias("p"), F.col("own").alias("digest"))
    first = x.where(f"k = 0 AND p < {block}").withColumns({"id": F.col("own"), "parent": F.coalesce("before", F.lit(ROOT))})
    if whole.isEmpty():
        return first.select(*items.columns, "id", "parent")
    upper = stored(prefixes(whole, block, level + 1), f"blocks{level}")
    below, up = (upper.select(F.col("c").alias(f"c{n}"), F.col("p").alias(f"q{n}"), F.col("id").alias(n)) for n in ("below", "up"))
    deep = x.where(f"k > 0 OR p = {block}")
    deep = deep.join(below, (F.col("c") == F.col("cbelow")) & (F.col("k") == F.col("qbelow")), "left")
    deep = deep.join(up, (F.col("c") == F.col("cup")) & (F.col("p") == F.col("qup") * block), "left")
    under = F.coalesce("below", F.lit(ROOT))        # block 0 stands on nothing
    inside = lambda c: F.when(F.col("k") == 0, F.col(c)).otherwise(_sha(F.col("below"), F.col(c)))
    deep = deep.withColumns({"id": F.coalesce(F.col("up"), inside("own")),
                             "parent": F.when(F.col("before").isNull(), under).otherwise(inside("before"))})
    cols = [*items.columns, "id", "parent"]
    return first.select(*cols).unionByName(deep.select(*cols))


def _pieces(batches):
    """Sorted (id, c) to pieces of comma-joined ids: (id, no, piece)."""
    at, held, no, out = None, [], 0, []

    def put():
        nonlocal held, no
        if held:
            out.append((at, no, ",".join(held)))
            held, no = [], no + 1

    def batch(rows):
        ids, nos, texts = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(nos, pa.int64()), pa.array(texts, pa.string())],
                                          ["id", "no", "piece"])

    for b in batches:
        for i, c in zip(b.column("id").to_pylist(), b.column("c").to_pylist()):
            if i != at or len(held) == CHUNK:
                put()
                at = i
            held.append(str(c))
            if len(out) >= 1024 or (out and len(out[-1][2]) > CHUNK):
                yield batch(out)
                out = []
    put()
    if out:
        yield batch(out)


def _joined(batches):
    """Sorted pieces to the SHA-256 of each id's list, streamed."""
    at, state, out = None, None, []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                           pa.array([r[1] for r in rows], pa.string())], ["id", "ends_sha256"])

    for b in batches:
        for i, piece in zip(b.column("id").to_pylist(), b.column("piece").to_pylist()):
            if i != at:
                if state:
                    out.append((at, state.hexdigest()))
                at, state = i, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if len(out) >= 10_000:
            yield batch(out)
            out = []
    if state:
        yield batch([*out, (at, state.hexdigest())])


def ends(pairs: DataFrame) -> DataFrame:
    """(id, ends_sha256) from (id, c): digest of each id's c in ascending order, comma-joined.

    Ranges of (id, c) make the pieces, so an id that holds most rows spreads over many tasks; one task then reads the
    id's pieces one by one, as a digest has to.
    """
    ranged = stored(pairs, "ends").repartitionByRange("id", "c").sortWithinPartitions("id", "c")
    pieces = ranged.mapInArrow(_pieces, "id binary, no bigint, piece string").withColumn("range", F.spark_partition_id())
    return pieces.repartition("id").sortWithinPartitions("id", "range", "no").select("id", "piece").mapInArrow(
        _joined, "id binary, ends_sha256 string")


def nodes(convs: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, words, ends_sha256): a row per node, the root included."""
    ids = stored(prefixes(rows, block), "prefixes")
    root, none = F.lit(ROOT), F.lit(None).cast("binary")
    members = ids.select("c", "p", "id", "parent", "words").unionByName(
        convs.select("c", F.lit(0).cast("bigint").alias("p"), root.alias("id"), none.alias("parent"), F.lit(0).cast("bigint").alias("words")))
    found = members.groupBy("id", "parent").agg(F.min("c").alias("conv_id"), F.max("p").alias("depth"),
                                                F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    found = stored(found, "nodes")
    finished = ids.where("last").select("id", "c").unionByName(convs.where("len = 0").select(root.alias("id"), "c"))
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    whole = found.join(children, "id", "left").join(ends(finished), "id", "left")
    above = found.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # many nodes have one parent: the last join, whose large partitions Spark may split
    return stored(whole, "counted_nodes").join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        "words", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


# ------------------------------------------------------------------ contraction

SUMS = ("a", "b")                   # what is totalled
LIVE, RAKED, SPLICED = 0, 1, 2


def _row(**values) -> Column:
    """A struct of long columns, from columns and plain values."""
    cols = {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    return F.struct(*(v.cast("bigint").alias(k) for k, v in cols.items()))


def _emit(df: DataFrame, *rows: Column) -> DataFrame:
    """Several rows from each one; those that are null are left out."""
    return df.select(F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def _rake(s: DataFrame) -> DataFrame:
    """Childless nodes give what they hold to their parents; every other node learns its living children."""
    childless = F.col("childless") == 1
    own = _row(**{x: F.col(x) for x in ("c", "d", "pc", "pd", "a", "b", "ea", "eb", "childless")}, kids=0, uc=None, ud=None, ua=0, ub=0)
    gift = lambda x: F.when(childless, F.col(x) + F.col(f"e{x}")).otherwise(0)
    edge = lambda x: F.when(childless, 0).otherwise(F.col(f"e{x}"))             # noqa: E731
    to_parent = F.when(F.col("pc").isNotNull(), _row(
        c=F.col("pc"), d=F.col("pd"), pc=None, pd=None, a=gift("a"), b=gift("b"), ea=0, eb=0, childless=0,
        kids=F.when(childless, 0).otherwise(1), uc=F.when(~childless, F.col("c")), ud=F.when(~childless, F.col("d")),
        ua=edge("a"), ub=edge("b")))
    sums = [F.sum(x).alias(x) for x in ("a", "b", "ea", "eb", "kids", "ua", "ub")]
    return _emit(s, own, to_parent).groupBy("c", "d").agg(
        *sums, *(F.max(x).alias(x) for x in ("pc", "pd", "childless", "uc", "ud")))


def _priority(round_no: int) -> Column:
    """Zeros that end the depth, then a hash of node and round; never equal but by accident."""
    zeros = F.bit_count(F.col("d").bitwiseAND(-F.col("d")) - 1).cast("bigint")
    return F.shiftleft(zeros, 56).bitwiseOR(F.xxhash64("c", "d", F.lit(round_no)).bitwiseAND(F.lit((1 << 56) - 1)))


def _choose(s: DataFrame, round_no: int) -> DataFrame:
    """``go``: nodes with one living child that are spliced out in this round; no two of them are neighbours."""
    chain = (F.col("childless") == 0) & (F.col("kids") == 1) & F.col("pc").isNotNull()
    s = s.withColumn("rank", F.when(chain, _priority(round_no)))
    cols = ("pc", "pd", "a", "b", "ea", "eb", "childless", "kids", "uc", "ud", "ua", "ub", "rank")
    gone = {x: None for x in cols}
    own = _row(c=F.col("c"), d=F.col("d"), **{x: F.col(x) for x in cols}, near=None)
    up = F.when(F.col("rank").isNotNull(), _row(c=F.col("pc"), d=F.col("pd"), **gone, near=F.col("rank")))
    down = F.when(F.col("rank").isNotNull(), _row(c=F.col("uc"), d=F.col("ud"), **gone, near=F.col("rank")))
    s = _emit(s, own, up, down).groupBy("c", "d").agg(*(F.max(x).alias(x) for x in cols), F.min("near").alias("near"))
    return s.withColumn("go", F.col("rank").isNotNull() & (F.col("near").isNull() | (F.col("rank") < F.col("near"))))


def _splice(s: DataFrame) -> DataFrame:
    """The next round's table: state, and for spliced nodes the child and what lies between its total and theirs."""
    state = F.when(F.col("childless") == 1, RAKED).when(F.col("go"), SPLICED).otherwise(LIVE)
    between = lambda x: F.when(F.col("go"), F.col(x) + F.col(f"u{x}")).otherwise(F.col(x))      # noqa: E731
    own = _row(c=F.col("c"), d=F.col("d"), state=state, pc=F.col("pc"), pd=F.col("pd"), a=between("a"), b=between("b"),
               ea=F.col("ea"), eb=F.col("eb"), kids=F.col("kids"), uc=F.col("uc"), ud=F.col("ud"), nc=None, nd=None)
    down = F.when(F.col("go"), _row(
        c=F.col("uc"), d=F.col("ud"), state=None, pc=None, pd=None, a=0, b=0, ea=F.col("a") + F.col("ea"),
        eb=F.col("b") + F.col("eb"), kids=0, uc=None, ud=None, nc=F.col("pc"), nd=F.col("pd")))
    s = _emit(s, own, down).groupBy("c", "d").agg(
        *(F.sum(x).alias(x) for x in ("a", "b", "ea", "eb", "kids")), *(F.max(x).alias(x) for x in ("state", "pc", "pd", "uc", "ud", "nc", "nd")))
    return s.select("c", "d", "state", F.coalesce("nc", "pc").alias("pc"), F.coalesce("nd", "pd").alias("pd"), "a", "b", "ea", "eb",
                    F.when(F.col("kids") == 0, 1).otherwise(0).cast("bigint").alias("childless"), "uc", "ud")


def totals(tree: DataFrame) -> DataFrame:
    """(c, d, a, b): sums of a and b over every node's subtree, from (c, d, pc, pd, a, b, childless).

    (pc, pd) is the parent's (c, d), null for roots; depths d rise by one from parent to child.
    """
    live = tree.select("c", "d", "pc", "pd", "a", "b", F.lit(0).cast("bigint").alias("ea"), F.lit(0).cast("bigint").alias("eb"), "childless")
    rounds: list[DataFrame] = []
    left = 1
    while left:
        done = stored(_splice(_choose(_rake(live), len(rounds))), f"round{len(rounds)}")
        rounds.append(done)
        live = done.where(F.col("state") == LIVE)
        left = live.count()
    known = None
    for done in reversed(rounds):
        raked = done.where(F.col("state") == RAKED).select("c", "d", "a", "b")
        if known is None:
            known = raked               # the last round leaves nothing but raked nodes
            continue
        below = known.select(F.col("c").alias("uc"), F.col("d").alias("ud"), F.col("a").alias("ua"), F.col("b").alias("ub"))
        spliced = done.where(F.col("state") == SPLICED).join(below, ["uc", "ud"])
        spliced = spliced.select("c", "d", (F.col("a") + F.col("ua")).alias("a"), (F.col("b") + F.col("ub")).alias("b"))
        known = stored(known.unionByName(raked).unionByName(spliced), "known")
    return known


def trie(conversations: DataFrame, every: int = 20, block: int = BLOCK) -> DataFrame:
    """A row per node of the trie of rebuilt conversations (conv_id, turn, role, text); see ``turns`` for nulls and ties.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).  A conversation without
    rebuilt turns is a member of the root alone and ends there.  An empty table has no nodes.
    """
    convs, rows = rebuilt(turns(conversations), every)
    found = stored(nodes(convs, rows, block), "trie")
    tree = found.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"),
                        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("pd"),
                        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("a"),
                        ((F.col("n_convs") - 1) * F.col("words")).alias("b"),
                        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("childless"))
    sums = totals(tree).select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("a").alias("n_leaves"), F.col("b").alias("saved_tokens"))
    return found.join(sums, ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                                         "n_leaves", "saved_tokens", "ends_sha256")


def oracle_sql(every: int = 20) -> str:
    """DuckDB SQL for ``trie(conversations)``: every prefix as a text, every node under each of its ancestors."""
    from pasture.llm.merkle_manifest import _CRC, crc32_sql
    return rf"""
WITH {_CRC},
t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS dg,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg) AS pos FROM t),
cs AS (SELECT conv_id AS c, conv_id - conv_id % {every} AS base, {crc32_sql('conv_id::VARCHAR')} % 4 AS h
       FROM (SELECT DISTINCT conv_id FROM t), crc),
b AS (SELECT c, 0 AS part, pos, dg, w FROM cs JOIN o ON o.conv_id = base AND pos <= h
      UNION ALL SELECT c, 1, pos, dg, w FROM cs JOIN o ON o.conv_id = c AND pos > h),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS p, count(*) OVER (PARTITION BY c) AS n, w,
             sha256(string_agg(dg, '') OVER (PARTITION BY c ORDER BY part, pos)) AS id FROM b),
m AS (SELECT c, p, n, w, id FROM r
      UNION ALL SELECT c, 0, coalesce((SELECT max(p) FROM r WHERE r.c = cs.c), 0), 0, '' FROM cs),
nd AS (SELECT id, p, min(c) AS c, count(*) AS k, max(w) AS w,
              string_agg(CASE WHEN p = n THEN c::VARCHAR END, ',' ORDER BY c) AS ends FROM m GROUP BY id, p),
up AS (SELECT nd.id, nd.p, a.id AS above FROM nd JOIN m a ON a.c = nd.c AND a.p = nd.p - 1),
ch AS (SELECT above AS id, count(*) AS n FROM up GROUP BY above),
sub AS (SELECT a.id, sum(CASE WHEN ch.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((nd.k - 1) * nd.w) AS saved
        FROM nd JOIN m a ON a.c = nd.c AND a.p <= nd.p LEFT JOIN ch ON ch.id = nd.id GROUP BY a.id)
SELECT nd.c AS conv_id, nd.p::BIGINT AS depth, pn.c AS parent_conv_id, nd.k::BIGINT AS n_convs, coalesce(ch.n, 0)::BIGINT AS n_children,
       sub.leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(coalesce(nd.ends, '')) AS ends_sha256
FROM nd JOIN sub USING (id) LEFT JOIN ch USING (id) LEFT JOIN up USING (id) LEFT JOIN nd pn ON pn.id = up.above
"""
