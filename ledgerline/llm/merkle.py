"""Merkle manifest of a dataset, and proofs by a recursive query that climbs it.

A row's leaf is the SHA-256 of its fields. The leaves of a group (``lang``) ascend by id; every two
consecutive nodes, and a last one alone, become the SHA-256 of their digests, until one is left:
the group's subroot. The subroots, ordered by group, make the root in the same way.

*Build.* Leaves are numbered by a sort over the cluster (``common.numbered``), so a group that holds most
rows is spread. A pass shuffles runs of 256 nodes together and builds up to eight levels of each
inside a task with SQL array functions; a pass leaves a 256th of the nodes.

*Store.* The levels are written as node rows linked to their parents: a row covers eight levels. The row
(tree, block, step) is the step-th one on the way from the 256 leaves of ``block`` up to the root, and the
row with step + 1 is its parent. A row at step 1 holds all digests of its levels, one above only the path
that its block takes. Rows above are repeated for each block, a thousandth of the leaves' bytes,
so that no more than 256 leaves ever meet in one join key, at any height. (One row per node and level
would move about 26 x 200 bytes a leaf through Spark's recursion, more than the input itself.)

*Climb.* A Spark recursive query starts at every leaf, joins its row's parent link in each step, appends
the siblings and folds the leaf's digest, tampered or not, up to the root.

Defined cases: null fields count as ``-``. Equal ids are ordered by leaf digest, null ids come first, and
equal rows are leaves of their own. A null group is a group. A lone leaf is its subroot, a lone subroot the
root. An empty table gives no rows. Other columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

#: Levels that one pass builds, one node row covers and one step climbs; and the nodes below them.
LEVELS = 8
RUN = 1 << LEVELS

#: The fields of a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(**changed: Column) -> Column:
    """The binary digest of a row's fields; ``changed`` replaces some of them."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _digest(*nodes: str) -> str:
    """SQL of a node's binary digest from its children's binary digests, which count as hex text."""
    text = ", ".join(f"coalesce(lower(hex({node})), '')" for node in nodes)
    return f"unhex(sha2(concat({text}), 256))"


def _pass(nodes: DataFrame, done: int) -> DataFrame:
    """Blocks of RUN nodes (tree, n, pos, hash), each with the next levels: levels[0] are the nodes themselves.
    ``n`` is the number of the tree's leaves, ``done`` the levels below."""
    blocks = nodes.groupBy("tree", "n", F.shiftright("pos", LEVELS).alias("block")).agg(
        F.expr("transform(array_sort(collect_list(struct(pos, hash))), x -> x.hash)").alias("hashes")
    )
    height = F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))  # levels above the leaves
    upper = f"transform(sequence(0, (size(a[k - 1]) - 1) div 2), i -> {_digest('a[k - 1][2 * i]', 'get(a[k - 1], 2 * i + 1)')})"
    levels = f"aggregate(sequence(1, count), array(hashes), (a, k) -> concat(a, array({upper})))"
    counted = blocks.withColumn("height", height.cast("int")).withColumn("count", F.least(F.lit(LEVELS), F.col("height") - done))
    return counted.select("tree", "n", "height", "block", F.expr(f"if(count > 0, {levels}, array(hashes))").alias("levels"))


def build(leaves: DataFrame, largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels over leaves (tree, n, pos, hash) of trees of at most ``largest`` leaves: a written frame of blocks
    per pass, from the leaves up, and (tree, hash) of the trees' tops."""
    passes: list[DataFrame] = []
    tops = None
    nodes = leaves.select("tree", "n", "pos", "hash")
    while not passes or largest > 1 << LEVELS * len(passes):
        blocks = common.materialize(_pass(nodes, LEVELS * len(passes)), f"{name}-{len(passes)}")
        passes.append(blocks)
        done = LEVELS * len(passes)
        up = blocks.select("tree", "n", "height", F.col("block").alias("pos"), F.expr("element_at(levels, -1)[0]").alias("hash"))
        finished = up.filter((F.col("height") <= done) & (F.col("height") > done - LEVELS) | (F.lit(len(passes) == 1) & (F.col("height") == 0)))
        tops = finished.select("tree", "hash") if tops is None else tops.unionByName(finished.select("tree", "hash"))
        nodes = up.filter(F.col("height") > done)
    return passes, tops


PATH = "tree long, pos long, step int, siblings array<binary>, turns int"


def paths(passes: list[DataFrame], skipped: int) -> DataFrame:
    """(tree, pos, step, siblings, turns): what a climb from node ``pos`` of level 8 * ``skipped`` meets, a row for each
    pass above. ``siblings`` are digests or null, and bit i of ``turns`` says whether the i-th step comes from the right."""
    found = passes[0].sparkSession.createDataFrame([], PATH)
    for k in range(skipped, len(passes)):
        slots = passes[k].select("tree", "n", "block", "levels", F.explode(F.sequence(F.lit(0), F.size(F.col("levels")[0]) - 1)).alias("turns"))
        rows = slots.select(
            "tree", "n", (F.col("block") * RUN + F.col("turns")).alias("pos"), F.lit(k - skipped + 1).alias("step"), _siblings("turns").alias("siblings"), "turns"
        )
        for below in range(k - 1, skipped - 1, -1):  # repeated for all nodes below, RUN at a time
            last = F.shiftright(F.col("n") - 1, LEVELS * below)
            spread = F.sequence(F.col("pos") * RUN, F.least(F.col("pos") * RUN + RUN - 1, last))
            rows = rows.repartition("tree", "pos").withColumn("pos", F.explode(spread))
        found = found.unionByName(rows.select("tree", "pos", "step", "siblings", "turns"))
    return found


def _siblings(slot: str) -> Column:
    return F.expr(
        f"if(size(levels) > 1, transform(sequence(0, size(levels) - 2), i -> get(levels[i], shiftright({slot}, i) ^ 1)), cast(array() as array<binary>))"
    )


_FOLDED = (
    "aggregate(if(size(siblings) > 0, sequence(0, size(siblings) - 1), cast(array() as array<int>)), hash, (h, i) -> CASE "
    f"WHEN siblings[i] IS NULL THEN {_digest('h')} "
    f"WHEN shiftright(turns, i) & 1 = 0 THEN {_digest('h', 'siblings[i]')} ELSE {_digest('siblings[i]', 'h')} END)"
)

#: A step: the leaf's row of the manifest that has the next step number is the parent of the last one.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT key, tree, block, 0 AS step, slot, hash, CAST(array() AS ARRAY<BINARY>) AS siblings FROM {{leaves}}
  UNION ALL
  SELECT key, tree, block, step, slot, {_FOLDED} AS hash, siblings FROM (
    SELECT c.key, c.tree, c.block, r.step, c.slot, c.hash, coalesce(r.turns, c.slot) AS turns,
      CASE WHEN r.siblings IS NOT NULL THEN r.siblings
           WHEN size(r.levels) > 1 THEN transform(sequence(0, size(r.levels) - 2), i -> get(r.levels[i], shiftright(c.slot, i) ^ 1))
           ELSE CAST(array() AS ARRAY<BINARY>) END AS siblings
    FROM climb c JOIN {{nodes}} r ON r.tree = c.tree AND r.block = c.block AND r.parent_of = c.step) way)
SELECT key, step, hash, siblings FROM climb"""


def manifest(rows: DataFrame, tampered: Column, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """Per row: ``order``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest of the siblings up to the root),
    ``folded_root`` (climbed from the leaf ``tampered`` where that is not null, else from ``leaf``) and ``verified``.
    Digests are lowercase hex text."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the climb has a row per leaf and step
    hashed = rows.select(F.col(order).alias("id"), F.col(group).alias("lang"), leaf().alias("leaf"), tampered.alias("bad"))
    written, ranges = common.numbered(hashed, ["lang"], ["id", "leaf"], "merkle-rows")

    # Groups in order are the trees 0, 1, ...; the tree of their subroots is number -1.
    langs, lang_ranges = common.numbered(ranges.groupBy("lang").agg(F.sum("n").alias("n")), [], ["lang"], "merkle-groups")
    tree = (F.col("key") - F.col("first") + F.col("start")).alias("tree")
    trees = common.materialize(langs.join(lang_ranges.drop("n"), "part", "left").select("lang", "n", tree), "merkle-trees")
    sizes = trees.agg(F.count(F.lit(1)).alias("trees"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).first()
    spots = ranges.select(F.col("part").alias("p"), F.col("lang").alias("g"), (F.col("start") - F.col("first")).alias("offset"))
    spots = spots.join(trees, F.col("g").eqNullSafe(F.col("lang")), "left").drop("lang")
    place = written.join(spots, (F.col("part") == F.col("p")) & F.col("lang").eqNullSafe(F.col("g")), "left")
    leaves = common.materialize(place.select("key", "id", "leaf", "bad", "tree", "n", (F.col("key") + F.col("offset")).alias("pos")), "merkle-leaves")

    passes, tops = build(leaves.withColumnRenamed("leaf", "hash"), sizes["largest"], "merkle-levels")
    tops = common.materialize(tops, "merkle-subroots")
    subroots = tops.select(F.lit(-1).cast("long").alias("tree"), F.lit(sizes["trees"]).alias("n"), F.col("tree").alias("pos"), "hash")
    top_passes, top = build(subroots, sizes["trees"], "merkle-top")
    root = (top.select(F.lower(F.hex("hash")).alias("root")).first() or [None])[0]  # one digest

    blocks = passes[0].select("tree", "block", F.greatest(F.lit(1), F.ceil(F.col("height") / LEVELS)).cast("int").alias("own"))
    above = paths(top_passes, 0).select(F.col("pos").alias("tree"), "step", "siblings", "turns")
    within = passes[0].select("tree", "block", F.lit(1).alias("step"), "levels")
    upper = paths(passes, 1).select("tree", F.col("pos").alias("block"), (F.col("step") + 1).alias("step"), "siblings", "turns")
    upper = upper.unionByName(
        blocks.join(above, "tree", "left").select("tree", "block", (F.col("own") + F.col("step")).alias("step"), "siblings", "turns")
    )
    nodes = within.unionByName(upper, allowMissingColumns=True).withColumn("parent_of", F.col("step") - 1)
    nodes = common.materialize(nodes, "merkle-nodes")

    start = leaves.select(
        "key", "tree", F.shiftright("pos", LEVELS).alias("block"), F.col("pos").bitwiseAND(RUN - 1).cast("int").alias("slot"), F.coalesce("bad", "leaf").alias("hash")
    )
    climb = spark.sql(CLIMB, leaves=start, nodes=nodes)
    given = leaves.select("key", F.lit(-1).alias("step"), F.col("leaf").alias("hash"), "id", "tree")
    ways = climb.unionByName(given, allowMissingColumns=True).groupBy("key")
    ways = ways.agg(F.array_sort(F.collect_list(F.struct("step", "hash", "siblings", "id", "tree"))).alias("way"))
    proof = "transform(filter(flatten(filter(way.siblings, s -> s IS NOT NULL)), s -> s IS NOT NULL), s -> lower(hex(s)))"
    found = ways.select(
        F.col("way")[0]["id"].alias(order),
        F.col("way")[0]["tree"].alias("tree"),
        F.lower(F.hex(F.col("way")[0]["hash"])).alias("leaf"),
        F.expr(f"sha2(concat_ws('', {proof}), 256)").alias("proof_sha256"),
        F.lower(F.hex(F.element_at("way", -1)["hash"])).alias("folded_root"),
    )
    found = found.join(tops.select("tree", F.lower(F.hex("hash")).alias("subroot")), "tree", "left")
    return found.select(
        order, "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified")
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof digest and verification of every row of ``documents``. Where 7 divides the crc32 of the
    doc_id, the row is tampered with: n_chars + 1."""
    docs = common.table(spark, sf_dir, "documents").select(*FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(docs, F.when(chosen, leaf(n_chars=F.col("n_chars") + 1)))
