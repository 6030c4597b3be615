"""Conversation prefix trie by fixed-length block hashing.

A node is a distinct sequence of first turns; the conversations that begin with it are its members.

*Blocks first.* Every conversation is cut into blocks of BLOCK turns. A turn's digest includes its place, so the
sum of such digests over the first blocks (four limbs of 32 bits) names the sequence so far, and running
sums over any number of blocks need no chain of rounds. Conversations are grouped by the digest behind each
successive block: a group of equal copies, or all that share a long prompt, is one row from here on.

*Turns where siblings diverge.* Where all members that go beyond a boundary share the next block, the nodes
inside it have just those members, and nothing is compared. Only below a boundary with several different next blocks
are the blocks' turn prefixes grouped again, a row a block and not a row a conversation.

*Sums over subtrees* need no climb. A conversation owns the nodes of which it is the smallest member; these are
the last ones on its path. With Q(c) the words of c before the first node that it owns, a subtree at
depth d with smallest member m saves sum(Q(c) - words before depth d) over its members c other than m, and its leaves are
counted at their owners. Both are sums over members, so they go through the same blocks.

Groups of any size are partial sums; turns are numbered by a sort over the cluster (``common.numbered``), and running sums are
taken over at most 1,024 blocks and then over their totals, so one conversation may hold most rows. The digest of a node's
ending members is streamed over sorted pieces of 4,096 ids.

Defined cases: null role or text is empty. Null turns come first; turns that tie are ordered by their digest, and
repeated rows are turns of their own. Rows without conv_id belong to no conversation. An empty table gives no node.
A conversation has fewer than 2^31 turns (the limbs' sums). Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import common

#: Turns of a block, and as a power of two: blocks of a run of running sums, ids of a piece of an ending digest.
BLOCK = 4
RUN_BITS = 10
PIECE_BITS = 12

LIMBS = ["d1", "d2", "d3", "d4"]
WORD = r"[^\x20\x09-\x0D]+"


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words): all that is needed of a turn's role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter(F.col("conv_id").isNotNull())
    return rows.select(F.col("conv_id").cast("long"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with ``key`` and ``part``, and the ranges in which to look up their place (``common.numbered``)."""
    return common.numbered(turn_digests(conversations), ["conv_id"], ["turn", "digest"], "trie-turns")


def _spot(ranges: DataFrame) -> DataFrame:
    return ranges.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), (F.col("start") - F.col("first")).alias("offset"))


def placed(turns: DataFrame, ranges: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words), pos from 0."""
    spots = _spot(ranges)
    rows = turns.join(spots, (F.col("part") == F.col("p")) & (F.col("conv_id") == F.col("c")), "left")
    return rows.select("conv_id", (F.col("key") + F.col("offset")).alias("pos"), "digest", "words")


def with_shared_heads(turns: DataFrame, ranges: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first h turns of conversation c - c % ``every``, then c's own turns after its first h; h is
    crc32(c) % ``most``. Returns placed turns, and (conv_id, n_turns) of all conversations."""
    sizes = ranges.groupBy("conv_id").agg(F.sum("n").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    wanted = sizes.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("head"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("own").alias("head_turns")).filter(F.col("head") % every == 0)
    taken = F.least(F.col("h"), F.coalesce("head_turns", F.lit(0))).alias("taken")
    plan = common.materialize(wanted.join(heads, "head", "left").select("conv_id", "own", "h", "head", taken), "trie-rebuild")

    spots = _spot(ranges).join(plan.select(F.col("conv_id").alias("c"), "h", "taken"), "c")  # a row a range and conversation
    own = turns.join(spots, (F.col("part") == F.col("p")) & (F.col("conv_id") == F.col("c")))
    own = own.withColumn("place", F.col("key") + F.col("offset")).filter("place >= h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")

    first = placed(turns.filter(F.col("conv_id") % every == 0), ranges.filter(F.col("conv_id") % every == 0)).filter(F.col("pos") < most)
    shared = plan.filter("taken > 0").select("conv_id", "head", "taken")
    shared = shared.join(first.withColumnRenamed("conv_id", "head"), "head").filter("pos < taken").select("conv_id", "pos", "digest", "words")
    counts = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(shared), counts


def _mod(limb: Column) -> Column:
    return limb.bitwiseAND(0xFFFFFFFF)


def _limbs(row: str) -> Column:
    """A turn's digest with its place: the halves of two 64-bit hashes that differ from the first byte on."""
    hashes = [F.xxhash64(F.lit(seed), F.col(f"{row}digest"), F.col(f"{row}pos")) for seed in (1, 2)]
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), _mod(h))]
    return F.struct(*(half.alias(name) for half, name in zip(halves, LIMBS, strict=True)))


def blocks_of(turns: DataFrame, counts: DataFrame) -> DataFrame:
    """A row a conversation and block: conv_id, j, ``turns`` (limbs and words in order), the name ``at`` of the sequence
    before the block and ``to`` behind it (structs of limbs), words before (``before``), and whether it is the last."""
    cut = turns.withColumn("at", _limbs("")).groupBy("conv_id", F.expr(f"pos div {BLOCK}").alias("j"))
    sums = [F.sum(f"at.{name}").alias(name) for name in LIMBS]
    blocks = cut.agg(F.array_sort(F.collect_list(F.struct("pos", "at", "words"))).alias("turns"), F.sum("words").alias("w"), *sums)
    blocks = common.materialize(blocks.withColumn("run", F.shiftright("j", RUN_BITS)), "trie-blocks")

    parts = [*LIMBS, "w"]
    runs = blocks.groupBy("conv_id", "run").agg(*(F.sum(c).alias(c) for c in parts))
    ahead = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"run_{c}") for c in parts))
    runs = runs.join(counts, "conv_id")
    inside = Window.partitionBy("conv_id", "run").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks.join(runs, ["conv_id", "run"])
    rows = rows.withColumns({f"ahead_{c}": F.col(f"run_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in parts})
    return rows.select(
        "conv_id", "run", "j", "turns", F.size("turns").alias("length"),
        F.struct(*(_mod(F.col(f"ahead_{c}")).alias(c) for c in LIMBS)).alias("at"),
        F.struct(*(_mod(F.col(f"ahead_{c}") + F.col(c)).alias(c) for c in LIMBS)).alias("to"),
        F.col("ahead_w").alias("before"),
        (F.col("ahead_w") + F.col("w")).alias("total"),
        (F.col("j") * BLOCK + F.size("turns") == F.col("n_turns")).alias("last"),
    )


def _groups(blocks: DataFrame) -> DataFrame:
    """Equal blocks behind equal sequences: one row each, with members, smallest member, and whether the
    turns inside need comparing, because another block follows the same sequence."""
    groups = blocks.groupBy("j", "length", "to").agg(
        F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"), F.first("at").alias("at"), F.first("turns").alias("turns"), F.first("before").alias("before")
    )
    groups = common.materialize(groups, "trie-groups")
    alone = groups.groupBy("j", "at").agg(F.count(F.lit(1)).alias("next"), F.max(F.struct("length", "to")).alias("only")).filter("next = 1")
    alone = alone.select("j", "only.length", "only.to", F.lit(False).alias("diverges"))
    return groups.join(alone, ["j", "length", "to"], "left").withColumn("diverges", F.coalesce("diverges", F.lit(True)))


def _root() -> Column:
    """The name of the empty sequence."""
    return F.struct(*(F.lit(0).cast("long").alias(c) for c in LIMBS))


#: How the values of a node's blocks are put together.
_COMBINED = {"members": F.sum, "least": F.min, "q": F.sum, "leaves": F.sum, "least_of": F.min}


def _inside(groups: DataFrame, sums: list[str], names: bool) -> DataFrame:
    """The nodes inside blocks: depth, name, the sums (and ``least``) and, with ``names``, parent, words and words before."""
    limbs = ", ".join(f"'{c}', (s.{c} + t.at.{c}) & 4294967295L" for c in LIMBS)
    name = f"aggregate(slice(turns, 1, %s), at, (s, t) -> named_struct({limbs}))"
    path = "before + aggregate(slice(turns, 1, i), 0L, (s, t) -> s + t.words)"
    step = (
        f"transform(sequence(1, length), i -> named_struct('depth', cast(j * {BLOCK} + i as long), 'node', {name % 'i'}, "
        f"'parent', {name % 'i - 1'}, 'words', turns[i - 1].words, 'path', {path}))"
    )
    rows = groups.select(*sums, "diverges", F.explode(F.expr(step)).alias("x")).select(*sums, "diverges", "x.*")
    facts = ["parent", "words", "path"] if names else []
    rows = rows.select("depth", "node", *facts, *sums, "diverges")
    same = rows.filter("not diverges").drop("diverges")
    apart = rows.filter("diverges").groupBy("depth", "node")
    apart = apart.agg(*(F.first(c).alias(c) for c in facts), *(_COMBINED[c](c).alias(c) for c in sums))
    return same.unionByName(apart)


def trie(turns: DataFrame, counts: DataFrame) -> DataFrame:
    """All nodes over placed ``turns`` (conv_id, pos, digest, words) of the conversations in ``counts`` (conv_id,
    n_turns), turnless ones included."""
    counts = common.materialize(counts, "trie-conversations")
    blocks = common.materialize(blocks_of(turns, counts), "trie-named")
    groups = common.materialize(_groups(blocks), "trie-block-nodes")
    root = counts.agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least")).filter("members > 0")
    root = root.select(
        F.lit(0).cast("long").alias("depth"), _root().alias("node"), F.lit(None).cast(groups.schema["at"].dataType).alias("parent"),
        F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("path"), "members", "least",
    )
    nodes = _inside(groups, ["members", "least"], True).unionByName(root)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("children"))
    nodes = nodes.join(children.filter("depth >= 0"), ["depth", "node"], "left").withColumn("children", F.coalesce("children", F.lit(0)))
    nodes = common.materialize(nodes, "trie-nodes")

    # what a conversation adds to every node above it: Q, and 1 where it owns a leaf
    owners = nodes.groupBy(F.col("least").alias("conv_id")).agg(
        F.min(F.struct("depth", (F.col("path") - F.col("words")).alias("q"))).alias("first"), F.sum(F.when(F.col("children") == 0, 1).otherwise(0)).alias("leaves")
    )
    ends = blocks.filter("last").select("conv_id", "to", "total")
    facts = counts.join(ends, "conv_id", "left").join(owners, "conv_id", "left")
    facts = facts.select(
        "conv_id", F.col("n_turns").alias("depth"), F.coalesce("to", _root()).alias("node"),
        F.coalesce("first.q", "total", F.lit(0)).alias("q"), F.coalesce("leaves", F.lit(0)).alias("leaves"),
    )
    facts = common.materialize(facts, "trie-members")
    runs = blocks.select("conv_id", "run").distinct().join(facts.select("conv_id", "q", "leaves"), "conv_id")
    valued = blocks.select("conv_id", "run", "j", "length", "to").join(runs, ["conv_id", "run"])
    valued = valued.groupBy("j", "length", "to").agg(
        F.sum("q").alias("q"), F.sum("leaves").alias("leaves"), F.min(F.struct("conv_id", "q")).alias("least_of")
    )
    sums = _inside(groups.join(valued, ["j", "length", "to"]), ["q", "leaves", "least_of"], False)
    at_root = facts.agg(F.sum("q").alias("q"), F.sum("leaves").alias("leaves"), F.min(F.struct("conv_id", "q")).alias("least_of"))
    sums = sums.unionByName(at_root.select(F.lit(0).cast("long").alias("depth"), _root().alias("node"), "q", "leaves", "least_of"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    saved = F.col("q") - F.col("least_of.q") - (F.col("members") - 1) * (F.col("path") - F.col("words"))
    rows = nodes.join(sums, ["depth", "node"]).join(parents, ["depth", "parent"], "left").join(_ending(facts), ["depth", "node"], "left")
    return rows.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").cast("long").alias("n_leaves"), saved.cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _ending(members: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256): the digest of the ascending ids of the conversations that end at a node. Ids are joined in pieces
    of an id range each; a task then reads a node's pieces in order and holds one of them at a time."""
    pieces = members.groupBy("depth", "node", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "piece")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            depths, nodes = [], []
            found: list[str] = []
            for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "node", "ids")), strict=True):
                if current != (depth, node):
                    if current is not None:
                        depths.append(current[0])
                        nodes.append(current[1])
                        found.append(state.hexdigest())
                    current, state = (depth, node), hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            yield _digest_batch(depths, nodes, found, batch.schema)
            last_schema = batch.schema
        if current is not None:
            yield _digest_batch([current[0]], [current[1]], [state.hexdigest()], last_schema)

    kind = members.schema["node"].dataType.simpleString()
    return ordered.select("depth", "node", "ids").mapInArrow(digests, f"depth long, node {kind}, ends_sha256 string")


def _digest_batch(depths: list, nodes: list, found: list, schema: pa.Schema) -> pa.RecordBatch:
    kinds = [schema.field("depth").type, schema.field("node").type, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((depths, nodes, found), kinds, strict=True)], ["depth", "node", "ends_sha256"])


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, each rebuilt with the head of the conversation at its twenty."""
    common.prepare(spark)
    return trie(*with_shared_heads(*numbered_turns(common.table(spark, sf_dir, "conversations"))))
