"""Merkle manifest of a table: a root, and a proof for every row.

Rows are leaves of one tree per group; the groups' roots are the leaves of a top
tree. A tree is built level by level, every level one aggregation of the level
below. Proofs come from pointer jumping over the inner nodes: a node holds the
sibling segments on its way towards an ancestor, and a self-join on that ancestor
appends the ancestor's own segments and doubles the distance. Leaves take the
finished path of their parent, so rows of the table are joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.llm.prefix import totals_before
from stewardry.llm.staging import staged

FAN = 8
# Bytes of a digest, and the bits of an index that give a place among siblings.
DIGEST = 32
BITS = FAN.bit_length() - 1
TOP = "top"
NODE = ["tree", "level", "index"]
PARENT = ["up_tree", "up_level", "up_index"]
PATH = "array<struct<place:int,others:binary>>"


def field(value: Column) -> Column:
    """A value as text that no other row of values can share: its length and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def grown(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The inner levels of all trees, from the leaves' parents upwards.

    ``leaves`` has ``tree, index, raw`` and ``n``, the leaves of its tree; ``most``
    is the largest ``n``. Each level has ``tree, level, index, n, raw, kids``, with
    ``n`` the nodes of that level and ``kids`` the digests below, in order.
    """
    levels, rows, level = [], leaves.select("tree", "index", "n", "raw"), 0
    while most > 1:
        level += 1
        kids = F.array_sort(F.collect_list(F.struct("index", "raw")))
        joined = F.aggregate(kids, F.lit(b"").cast("binary"), lambda a, k: F.concat(a, k["raw"]))
        above = (
            rows.where("n > 1")
            .groupBy("tree", F.shiftright("index", BITS).alias("index"))
            .agg(F.ceil(F.max("n") / FAN).alias("n"), joined.alias("kids"))
        )
        above = above.select(
            "tree", F.lit(level).alias("level"), "index", "n", F.unhex(F.sha2(hexed(F.col("kids")), 256)).alias("raw"), "kids"
        )
        rows = staged(above, f"level-{level}")
        levels.append(rows)
        most = -(-most // FAN)
    return levels


def segment(place: Column, kids: Column) -> Column:
    """The siblings beside the child at ``place``, as a path of one step."""
    before = F.substring(kids, F.lit(1), place * DIGEST)
    after = F.substring(kids, place * DIGEST + DIGEST + 1, F.lit(FAN * DIGEST))
    return F.array(F.struct(place.alias("place"), F.concat(before, after).alias("others"))).cast(PATH)


def place_of(index: Column) -> Column:
    return F.pmod(index, F.lit(FAN)).cast("int")


def jumped(nodes: DataFrame, depth: int) -> DataFrame:
    """The whole path to the root for every node: ``tree, level, index, path``.

    ``nodes`` has the node, its parent (null for the root) and the one-step path
    towards it. After round k a path covers 2**k steps, or ends at the root.
    """
    names = [*NODE, *PARENT, "path"]
    state = staged(nodes.select(*names), "jumps-0")
    reach, turn = 1, 0
    while reach < depth:
        turn += 1
        ahead = state.select(*[F.col(c).alias(f"a_{c}") for c in names])
        on = (F.col("up_tree") == F.col("a_tree")) & (F.col("up_level") == F.col("a_level")) & (F.col("up_index") == F.col("a_index"))
        joined = state.join(ahead, on, "left")
        path = F.concat("path", F.coalesce("a_path", F.array().cast(PATH)))
        state = staged(joined.select(*NODE, *[F.col(f"a_{c}").alias(c) for c in PARENT], path.alias("path")), f"jumps-{turn}")
        reach *= 2
    return state.select(*NODE, "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def step(below: Column, s: Column) -> Column:
        others, cut = hexed(s["others"]), s["place"] * (2 * DIGEST)
        return F.sha2(F.concat(F.substring(others, F.lit(1), cut), below, F.substring(others, cut + 1, F.lit(2 * FAN * DIGEST))), 256)

    return F.aggregate(path, leaf, step)


def manifest(rows: DataFrame, key: str, group: str, leaf: Column, shown: Column | None = None) -> DataFrame:
    """``key, group, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``leaf`` is a row's digest as hex text, ``shown`` the digest of the row as
    someone holds it (default: the same); a row is verified if that and the
    siblings of its leaf give the root. Leaves ascend by key in their group, nulls
    first, rows of one key by digest; rows repeated in full are leaves of their own,
    and a null group is a group. No rows: no rows.
    """
    spark = rows.sparkSession
    own = rows.select(
        F.col(key).alias("key"),
        F.col(group).alias("group"),
        F.unhex(leaf).alias("raw"),
        F.unhex(leaf if shown is None else shown).alias("shown"),
        field(F.col(group)).alias("tree"),
    )
    own = staged(own, "leaves")
    order = [F.col("key").asc_nulls_first(), F.col("raw"), F.col("shown")]
    placed = totals_before(own, ["tree"], order, F.lit(1), "index")
    trees = placed.groupBy("tree").agg(F.count("*").alias("n"), F.first("group").alias("group"))
    trees = totals_before(staged(trees, "trees"), [], [F.col("group").asc_nulls_first()], F.lit(1), "above")
    trees = staged(trees, "tops")
    n_trees, most = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    sizes = trees.select(F.col("tree").alias("_tree"), "n", "above")
    placed = staged(placed.join(sizes, F.col("tree") == F.col("_tree")).drop("_tree"), "placed")
    levels = grown(placed, most)

    # The root of each tree: its only node on the last level it reaches.
    alone = placed.where("n = 1").select(*[F.lit(0).alias(c) if c == "level" else F.col(c) for c in NODE], "raw")
    tips = [alone, *[level.where("n = 1").select(*NODE, "raw") for level in levels]]
    subroots = tips[0]
    for tip in tips[1:]:
        subroots = subroots.unionAll(tip)
    subroots = subroots.withColumnRenamed("raw", "subroot").join(sizes.drop("n"), F.col("tree") == F.col("_tree"))
    subroots = staged(subroots.select("_tree", "above", "subroot"), "subroots")
    top = subroots.select(F.lit(TOP).alias("tree"), F.col("above").alias("index"), F.lit(n_trees).alias("n"), F.col("subroot").alias("raw"))
    tops = grown(top, n_trees)
    root = (tops[-1] if tops else top).select(hexed(F.col("raw"))).first()
    root = root[0] if root else None

    inner = levels + tops
    if inner:
        nodes = inner[0]
        for level in inner[1:]:
            nodes = nodes.unionAll(level)
        # A tree's root hangs below the top tree, any other node below its own.
        nodes = nodes.join(subroots, F.col("tree") == F.col("_tree"), "left").drop("_tree")
        up = F.when(F.col("n") > 1, F.struct(F.col("tree").alias("tree"), (F.col("level") + 1).alias("level"), F.col("index").alias("index")))
        if n_trees > 1:
            up = up.when(F.col("tree") != TOP, F.struct(F.lit(TOP).alias("tree"), F.lit(1).alias("level"), F.col("above").alias("index")))
        nodes = nodes.withColumn("_up", up).select(
            *NODE,
            "subroot",
            "kids",
            F.col("_up.tree").alias("up_tree"),
            F.col("_up.level").alias("up_level"),
            F.shiftright("_up.index", BITS).alias("up_index"),
            place_of(F.col("_up.index")).alias("place"),
        )
        nodes = staged(nodes, "nodes")
        parents = nodes.select(*[F.col(c).alias(f"p_{c}") for c in NODE], F.col("kids").alias("p_kids"))
        on = (F.col("up_tree") == F.col("p_tree")) & (F.col("up_level") == F.col("p_level")) & (F.col("up_index") == F.col("p_index"))
        step = F.when(F.col("p_tree").isNull(), F.array().cast(PATH)).otherwise(segment(F.col("place"), F.col("p_kids")))
        stepped = nodes.join(parents, on, "left").select(*NODE, *PARENT, step.alias("path"))
        paths = jumped(stepped, len(levels) + len(tops))
        above = nodes.join(paths, NODE).select(
            F.col("tree").alias("p_tree"), F.col("level").alias("p_level"), F.col("index").alias("p_index"), "subroot", "kids", "path"
        )
        lone = F.col("n") == 1
        below = placed.select(
            "key",
            "group",
            "raw",
            "shown",
            F.when(lone, F.lit(TOP)).otherwise(F.col("tree")).alias("up_tree"),
            F.when(lone, F.col("above")).otherwise(F.col("index")).alias("at"),
            lone.alias("lone"),
        )
        on = (F.col("up_tree") == F.col("p_tree")) & (F.col("p_level") == 1) & (F.shiftright("at", BITS) == F.col("p_index"))
        joined = below.join(above.where("p_level = 1"), on, "left")
        steps = F.when(F.col("p_tree").isNull(), F.array().cast(PATH)).otherwise(
            F.concat(segment(place_of(F.col("at")), F.col("kids")), F.col("path"))
        )
        subroot = F.when(F.col("lone"), F.col("raw")).otherwise(F.col("subroot"))
    else:
        joined, steps, subroot = placed, F.array().cast(PATH), F.col("raw")
    proven = joined.select("key", "group", hexed(F.col("raw")).alias("leaf"), "shown", hexed(subroot).alias("subroot"), steps.alias("path"))
    siblings = F.array_join(F.transform("path", lambda s: hexed(s["others"])), "")
    proven = proven.withColumn("folded_root", folded(hexed(F.col("shown")), F.col("path"))).withColumn("proof_sha256", F.sha2(siblings, 256))
    return proven.select(
        F.col("key").alias(key),
        F.col("group").alias(group),
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
