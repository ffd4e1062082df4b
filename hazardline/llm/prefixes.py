"""Prefix trie of conversations (op 11) by ROLLUP over positional columns of turn ids.

Steps, all in stored tables (:func:`common.stage`) between the shuffles:

1. Turns are named by 128 bits of the SHA-256 of role and text; texts travel no further.  A range shuffle by
   (conversation, turn) splits a conversation of any length; each task numbers its own turns and adds up their lengths,
   and the one conversation that each task takes over from the task before gets the missing offset.
2. :func:`rebuilt` replaces first turns (the query's rule).  A conversation becomes one row per block of WIDTH turns:
   columns t1 .. tW, null behind its end.  A block is keyed by the node that the blocks before it lead to.  These keys come from
   pairwise hashing at distances 1, 2, 4 .., so their rounds grow with the logarithm of the longest conversation.
3. ``GROUP BY key, ROLLUP(t1 .. tW)`` counts all prefixes of all blocks at once; grouping_id tells the depth.
   Partial aggregation before the shuffle takes care of prefixes that a large share of the rows has.
4. A node's smallest member stands for it.  Along a conversation the nodes that it stands for are the deepest ones, so the tokens
   that the others could save below depth d are, for each member, the lengths from d up to where it begins to stand
   for nodes itself.  A second ROLLUP of the same rows adds these and the leaves.
5. The ids of conversations that end at a node are hashed in order: a range shuffle cuts them into chunks of text, and
   SHA-256, which has to see them one after the other, streams over a node's chunks in constant memory.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import join_counted, stage

#: Turn columns of a block; ids in a chunk of step 5.
WIDTH, CHUNK = 4, 2048
#: The query's rule: conversations are rebuilt in hundreds, with fewer than MOST_SHARED first turns of the hundred's first one.
HUNDRED, MOST_SHARED = 100, 6


def _digest(c: Column) -> Column:
    """The first 16 bytes of the SHA-256 of a binary column."""
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tid, len): null role and text are empty; rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                _digest(name).alias("tid"), F.char_length(text).cast("long").alias("len")).where("conv_id IS NOT NULL")


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, len, upto): turns in order (null first; equal numbers by tid), counted from 0, with the running
    sum of the lengths."""
    def local(batches):
        conv, n, total = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            c, size = b.column("conv_id").to_numpy(), b.column("len").to_numpy()
            new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            run = np.cumsum(size)
            first, count = np.repeat(new, np.diff(np.append(new, len(c)))), np.arange(len(c))
            pos, upto = count - first, run - run[first] + size[first]
            if c[0] == conv:                     # goes on from the batch before
                k = new[1] if len(new) > 1 else len(c)
                pos[:k] += n
                upto[:k] += total
            conv, n, total = c[-1], pos[-1] + 1, upto[-1]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(pos), b.column("tid"), b.column("len"), pa.array(upto), b.column("part")],
                                             names=["conv_id", "pos", "tid", "len", "upto", "part"])
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()) \
        .repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "tid", "_tie") \
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "tid", "_tie") \
        .select("conv_id", "tid", "len", F.spark_partition_id().cast("long").alias("part"))
    x = stage(dealt.mapInArrow(local, "conv_id long, pos long, tid binary, len long, upto long, part long"), "turns")
    # a conversation that several tasks hold: what the tasks before held.  Of a sorted range, at most the first and the last
    # conversation are cut, so no more than two rows a task come to the driver, and at most one offset a task goes back.
    held = x.groupBy("conv_id", "part").agg(F.max("pos").alias("n"), F.max("upto").alias("l"))
    cut = held.groupBy("conv_id").agg(F.collect_list(F.struct("part", "n", "l")).alias("parts")).where(F.size("parts") > 1)
    rows_ = [(c, sorted((p, n, s) for p, n, s in parts)) for c, parts in cut.collect()]
    offsets = [(c, p, sum(q[1] + 1 for q in ps[:k]), sum(q[2] for q in ps[:k])) for c, ps in rows_ for k, (p, _, _) in enumerate(ps) if k]
    if not offsets:
        return x.drop("part")
    more = x.sparkSession.createDataFrame(offsets, "conv_id long, part long, n long, l long")
    return x.join(F.broadcast(more), ["conv_id", "part"], "left") \
        .select("conv_id", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"), "tid", "len", (F.col("upto") + F.coalesce("l", F.lit(0))).alias("upto"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the query's rule: h = crc32(decimal id) % 6 first turns are those of the hundred's first
    conversation (all if it has fewer, none if there is none), then follow the own turns after the first h.

    Conversations: (conv_id, n, total), also those left without a turn."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("base")
    own = stage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"), F.max("upto").alias("all"),
                                             *[F.max(F.when(F.col("pos") < k, F.col("upto"))).alias(f"l{k}") for k in range(1, MOST_SHARED)]),
                "conversations")
    upto = F.array(F.lit(0), *[F.coalesce(F.col(f"l{k}"), F.lit(0)) for k in range(1, MOST_SHARED)])
    mine = own.select("conv_id", "rows", "all", h, base, upto.alias("u"))
    first = own.select(F.col("conv_id").alias("base"), F.col("rows").alias("base_rows"), upto.alias("base_u"))
    at = F.col("h").cast("int")
    mine = stage(mine.join(first, "base", "left").select(
        "conv_id", "base", "h", "rows", (F.least("h", F.coalesce("base_rows", F.lit(0))) - F.col("h")).alias("d_pos"),
        (F.coalesce(F.element_at("base_u", at + 1), F.lit(0)) - F.element_at("u", at + 1)).alias("d_upto"),
        (F.greatest(F.col("rows") - F.col("h"), F.lit(0)) + F.least("h", F.coalesce("base_rows", F.lit(0)))).alias("n"),
        (F.greatest(F.col("all"), F.element_at("u", at + 1)) - F.element_at("u", at + 1) + F.coalesce(F.element_at("base_u", at + 1), F.lit(0))).alias("total")),
        "rebuilt")
    tail = join_counted(turns, mine, "conv_id", ["h", "d_pos", "d_upto"], "rows", F.col("pos")).where("pos >= h") \
        .select("conv_id", (F.col("pos") + F.col("d_pos")).alias("pos"), "tid", "len", (F.col("upto") + F.col("d_upto")).alias("upto"))
    heads = turns.where(F.col("pos") < MOST_SHARED - 1).select(F.col("conv_id").alias("base"), "pos", "tid", "len", "upto")
    head = mine.select("conv_id", "base", "h").join(heads, "base").where("pos < h").select("conv_id", "pos", "tid", "len", "upto")
    return tail.unionByName(head), mine.select("conv_id", "n", "total")


def _spelled(upto: int) -> Column:
    """Key and first ``upto`` turn ids of a block; missing ones add nothing, all others have 16 bytes."""
    empty = F.lit(b"")
    return F.concat(F.col("key"), *[F.coalesce(F.col(f"t{j}"), empty) for j in range(1, upto + 1)])


def block_rows(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, b, key, up, t1.., before1..): blocks of ``width`` turns.  ``key`` names the turns of all blocks before,
    ``up`` is the node that the block before ends at (null in the first), ``before`` the length of all turns before one."""
    cols = [c for j in range(width) for c in (
        F.max(F.when(F.col("pos") % width == j, F.col("tid"))).alias(f"t{j + 1}"),
        F.max(F.when(F.col("pos") % width == j, F.col("upto") - F.col("len"))).alias(f"before{j + 1}"))]
    x = turns.groupBy("conv_id", F.floor(F.col("pos") / width).alias("b")).agg(*cols)
    none = conversations.where("n = 0").select("conv_id", F.lit(0).cast("long").alias("b"),
                                               *[F.lit(None).cast(t).alias(f"{c}{j + 1}") for j in range(width) for c, t in (("t", "binary"), ("before", "long"))])
    x = stage(x.unionByName(none), "blocks")
    last = conversations.agg(F.max("blocks")).first()[0] or 1
    if last == 1:
        return x.select("*", F.lit(b"").alias("key"), F.lit(None).cast("binary").alias("up"))
    # scan[i]: a name of blocks 0 .. i; at distance d, a pair of names of up to d blocks becomes one of up to 2d
    full = x.where(F.col(f"t{width}").isNotNull())
    scan = stage(full.select("conv_id", "b", _digest(F.concat(*[F.col(f"t{j}") for j in range(1, width + 1)])).alias("name")), "names")
    d = 1
    while d < last:
        earlier = scan.select("conv_id", (F.col("b") + d).alias("b"), F.col("name").alias("prev"))
        scan = stage(scan.join(earlier, ["conv_id", "b"], "left").select(
            "conv_id", "b", F.when(F.col("prev").isNull(), F.col("name")).otherwise(_digest(F.concat("prev", "name"))).alias("name")), "names")
        d *= 2
    key = scan.select("conv_id", (F.col("b") + 1).alias("b"), F.col("name").alias("key"))
    x = x.join(key, ["conv_id", "b"], "left").withColumn("key", F.coalesce("key", F.lit(b"")))
    x = stage(x, "keyed")
    up = x.where(F.col(f"t{width}").isNotNull()).select("conv_id", (F.col("b") + 1).alias("b"), _digest(_spelled(width)).alias("up"))
    return stage(x.join(up, ["conv_id", "b"], "left"), "keyed")


def _rollup(blocks: DataFrame, width: int, measures: str) -> DataFrame:
    """The prefixes of all blocks: id, up to the parent, depth and the measures.  A block's own key is the node that the block
    before ends at; only the root is taken from it."""
    ts = ", ".join(f"t{j}" for j in range(1, width + 1))
    x = blocks.sparkSession.sql(
        f"SELECT b, key, up, {ts}, {width} - bit_count(grouping_id() & {2 ** width - 1}) AS level, {measures} "
        f"FROM {{x}} GROUP BY b, key, up, ROLLUP({ts})", x=blocks)
    here = F.element_at(F.array(*[F.col(f"t{j}") for j in range(1, width + 1)]), F.greatest(F.col("level"), F.lit(1)).cast("int"))
    x = x.where(F.when(F.col("level") == 0, F.col("b") == 0).otherwise(here.isNotNull()))
    spelled = _spelled(width)
    shorter = F.substring(spelled, F.lit(1), F.octet_length(spelled) - 16)
    parent = F.when(F.col("level") > 1, _digest(shorter)).when(F.col("b") > 0, F.col("up")).when(F.col("level") == 1, _digest(F.lit(b"")))
    return x.withColumns({"id": _digest(spelled), "parent": parent, "depth": F.col("b") * width + F.col("level")})


def _by_level(name: str, width: int, first: int) -> Column:
    return F.element_at(F.array(*[F.col(f"{name}{j}") for j in range(first, width + 1)]), (F.col("level") + (1 - first)).cast("int"))


def ends_sha256(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) from (id, conv_id): SHA-256 of the decimal ids in numerical order, comma-joined."""
    def chunks(batches):
        node, first, held = None, None, []
        for b in batches:
            for i, c in zip(b.column("id").to_pylist(), b.column("conv_id").to_pylist()):
                if held and (i != node or len(held) == CHUNK):
                    yield row([(node, first, ",".join(held))], "text")
                    held = []
                if not held:
                    node, first = i, c
                held.append(str(c))
        if held:
            yield row([(node, first, ",".join(held))], "text")

    def row(found, what):
        if what == "text":
            i, f, t = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(i, pa.binary()), pa.array(f, pa.int64()), pa.array(t, pa.string())], names=["id", "first", "text"])
        i, t = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(i, pa.binary()), pa.array(t, pa.string())], names=["id", what])

    def digests(batches):
        rows = ((i, t) for b in batches for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()))
        out = []
        for node, parts in groupby(rows, lambda r: r[0]):
            h, comma = hashlib.sha256(), ""
            for _, t in parts:
                h.update((comma + t).encode())
                comma = ","
            out.append((node, h.hexdigest()))
            if len(out) == 10_000:
                yield row(out, "ends_sha256")
                out = []
        if out:
            yield row(out, "ends_sha256")
    cut = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(chunks, "id binary, first long, text string")
    return cut.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digests, "id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuild: bool = False, width: int = WIDTH) -> DataFrame:
    """One row per node of the prefix trie of ``conversations`` (conv_id, turn, role, text): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, equal ones by a hash of role and text; every row is a turn, repeated ones
    too.  Null role and text are empty.  Rows with a null conv_id belong to no conversation and are not used.  An empty table has
    no node, not even the root.  ``rebuild`` applies :func:`rebuilt` first.
    """
    turns = numbered(turn_rows(conversations))
    if rebuild:
        turns, convs = rebuilt(turns)
    else:
        convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("upto").alias("total"))
    convs = stage(convs.withColumn("blocks", F.greatest(F.ceil(F.col("n") / width), F.lit(1))), "lengths")
    blocks = block_rows(turns, convs, width)

    # pass 1: members, and the length before a node's turn (all members have the same)
    mins = ", ".join(f"min(before{j}) AS before{j}" for j in range(1, width + 1))
    nodes = _rollup(blocks, width, f"min(conv_id) AS conv_id, count(*) AS n_convs, {mins}")
    before = F.when(F.col("level") == 0, F.lit(0)).otherwise(_by_level("before", width, 1).cast("long"))
    nodes = stage(nodes.select("id", "parent", "depth", "conv_id", "n_convs", before.alias("before")), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    # pass 2: for each conversation the length up to where it begins to stand for nodes, and whether it ends at a leaf of its own
    stands = nodes.groupBy("conv_id").agg(F.min("before").alias("s"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    members = stage(convs.join(stands, "conv_id", "left").select("conv_id", "n", "blocks", F.coalesce("s", "total").alias("s"),
                                                                 F.coalesce("leaf", F.lit(0)).alias("leaf")), "members")
    rows = join_counted(blocks, members, "conv_id", ["n", "s", "leaf"], "blocks", F.col("b"))
    rows = stage(rows.select("*", F.col("s").alias("save0"), *[F.greatest(F.col("s") - F.col(f"before{j}"), F.lit(0)).alias(f"save{j}")
                                                                for j in range(1, width + 1)]), "members-blocks")
    sums = ", ".join(f"sum(save{j}) AS save{j}" for j in range(width + 1))
    below = _rollup(rows, width, f"sum(leaf) AS n_leaves, {sums}").select("id", "n_leaves", _by_level("save", width, 0).alias("saved_tokens"))
    ends = rows.where(F.col("b") == F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / width)).select(_digest(_spelled(width)).alias("id"), "conv_id")

    out = nodes.join(below, "id").join(ends_sha256(ends), "id", "left")
    out = stage(out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).drop("before"), "trie")
    parents = stage(nodes.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"), "parents")
    values = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = join_counted(out.where("parent IS NOT NULL"), parents, "parent", ["parent_conv_id"], "n_children", F.col("id"))
    root = out.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return inner.unionByName(root).select(*values[:2], "parent_conv_id", *values[2:])
