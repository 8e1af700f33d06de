"""Similarity join of texts by their word n-grams, along chosen paths.

Texts of the same words are one class. A class is a set of hashed n-grams, from
which minimum hashes sample tokens at a number of coordinates; two sets share the
token of a coordinate with their Jaccard similarity as chance. In each run, nodes
that hold many sets are split on the tokens of two coordinates, again and again,
so that a pair stays together in at least one child with 1 - (1 - J)**2; small
nodes, and nodes that a split hardly thins as their sets are all alike, are
compared by brute force. The chance that a pair at the threshold gets lost in a
run of any depth is the fixed point of q = (1 - J + J q)**2, which gives the
number of runs for a target recall.

Nodes compare samples only, to find which sets hang together. The sets that do
are then compared in full, in tiles of bounded size, so every link is exact and
each is counted once; pairs never become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.components import components
from stewardry.llm.staging import hidden, staged
from stewardry.llm.texts import U64, mix, plain_word_hashes, powers, signed, texts_of
from stewardry.llm.token_files import groups

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
COORDINATES = 64
BRANCHES = 2
# Sets that a node may hold to be compared at once, and levels of splitting.
LEAF = 64
DEPTH = 8
# A node that keeps more than this part of its parent is all alike.
DENSE = 0.5
# Sets of a tile of sketches, and n-grams and sets of a tile of full sets.
SKETCH_TILE = 256
TILE_GRAMS = 250_000
TILE_SETS = 1024

_FACTORS = mix(np.arange(COORDINATES), 11) | U64(1)
_OFFSETS = mix(np.arange(COORDINATES), 12)


def runs_for(recall: float, threshold: float) -> int:
    """Runs that find a pair at the threshold with the given chance."""
    lost = 1 - threshold
    for _ in range(1000):
        lost = (1 - threshold + threshold * lost) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost))) if lost > 0 else 1


def gram_set(words: np.ndarray, gram: int) -> np.ndarray:
    """The sorted set of hashed n-grams of word hashes."""
    p = powers(6)
    return np.unique(mix(p.windows(p.prefix(words), gram)))


def sketch(grams: np.ndarray) -> np.ndarray:
    """The token sampled at each coordinate, as 32 bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, U64)
    for at in range(0, len(grams), 4096):
        block = grams[at : at + 4096]
        least = np.minimum(least, (block[None, :] * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1))
    return (least >> U64(32)).astype(np.uint32)


def slack(threshold: float) -> int:
    """Coordinates that similar sets share but for one pair in some ten thousand."""
    spread = math.sqrt(threshold * (1 - threshold) * COORDINATES)
    return max(1, int(threshold * COORDINATES - 4 * spread))


def _documents(documents: DataFrame, text: str, key: str) -> DataFrame:
    return documents.select(F.col(key).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))


def find_sets(rows: DataFrame, gram: int) -> DataFrame:
    """``doc, version, cls, n_grams, sketch`` of every row; ``cls`` names its words."""
    kind = rows.schema["doc"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, sketches = [], [], []
            for text in texts_of(batch.column("text")):
                words = plain_word_hashes(text)
                n = np.array([len(words)], U64)
                pair = [mix(p.prefix(words)[-1:] ^ mix(n, 13)) for p in (powers(7), powers(8))]
                names.append(np.concatenate(pair).tobytes())
                grams = gram_set(words, gram)
                sizes.append(len(grams))
                sketches.append(sketch(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), batch.column("version"), pa.array(names, pa.binary()),
                    pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()),
                ],
                ["doc", "version", "cls", "n_grams", "sketch"],
            )

    return rows.mapInArrow(find, f"doc {kind}, version long, cls binary, n_grams long, sketch binary")


def _children(sets: DataFrame, roots: int | None) -> DataFrame:
    """``node, parent, cls``: the children of each node in which a set falls.

    ``roots`` starts that many runs from ``cls, sketch``; else ``sets`` also has
    ``node`` and its number of sets, ``n``.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            for run in range(roots or 1):
                if roots:
                    node, parent = np.full(len(tokens), run, U64), pa.nulls(len(tokens), pa.int64())
                    # Runs start from coordinates of their own.
                    first = np.full(len(tokens), run * BRANCHES % COORDINATES)
                else:
                    node, parent = batch.column("node").to_numpy().view(U64), batch.column("n")
                    first = (mix(node, 14) % U64(COORDINATES)).astype(np.int64)
                for k in range(BRANCHES):
                    if roots:
                        at = (first + k) % COORDINATES
                    else:
                        # An odd step, so that the two differ.
                        at = (first + k * (1 + 2 * (mix(node, 15) % U64(COORDINATES // 2)).astype(np.int64))) % COORDINATES
                    token = tokens[np.arange(len(tokens)), at].astype(U64)
                    child = mix(node ^ mix(token | (at.astype(U64) << U64(32)), 16), 17)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(child)), parent, batch.column("cls")], ["node", "parent", "cls"]
                    )

    return sets.mapInArrow(split, "node long, parent long, cls binary")


def find_leaves(classes: DataFrame, runs: int) -> DataFrame:
    """``leaf, side, cls``: the sets to compare; sides 0 and 1 only with each
    other, side 2 among themselves."""
    sketches = classes.select("cls", "sketch")
    level = staged(_children(sketches, runs), "paths")
    leaves = None
    for depth in range(1, DEPTH + 1):
        counts = level.groupBy(F.col("node").alias("_node")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        held = staged(level.join(counts, F.col("node") == F.col("_node")).drop("_node"), "nodes")
        small = held.where(F.col("n") <= LEAF).groupBy("node").agg(F.array_sort(F.collect_set("cls")).alias("sets"))
        # Runs and paths often end in the same sets.
        small = small.select("sets").distinct().select(F.xxhash64("sets").alias("leaf"), F.explode("sets").alias("cls"))
        small = small.select("leaf", F.lit(2).alias("side"), "cls")
        alike = F.col("n") > F.coalesce(F.col("parent"), F.lit(2**62)) * DENSE
        alike = alike if depth < DEPTH else F.lit(True)
        large = held.where(F.col("n") > LEAF)
        tiles = F.ceil(F.col("n") / SKETCH_TILE).cast("int")
        dense = large.where(alike).withColumn("_t", tiles)
        dense = dense.withColumn("_mine", F.pmod(F.xxhash64("cls"), F.col("_t")).cast("int"))
        dense = dense.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_t") - 1))).select(
            F.xxhash64("node", F.least("_mine", "_other"), F.greatest("_mine", "_other")).alias("leaf"),
            F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1).alias("side"),
            "cls",
        )
        found = small.unionByName(dense)
        leaves = found if leaves is None else leaves.unionByName(found)
        rest = large.where(~alike).select("node", "n", F.col("cls").alias("_cls"))
        if depth == DEPTH or rest.isEmpty():
            return leaves
        level = staged(_children(rest.join(sketches, F.col("_cls") == F.col("cls")).drop("_cls"), None), "paths")
    return leaves


class Joined:
    """Sets that hang together within one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def sketch_edges(leaves: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: for each leaf, sets whose samples agree, each joined to the least
    that it hangs together with."""
    least = slack(threshold)
    rows = leaves.join(classes.select(F.col("cls").alias("_cls"), "sketch"), F.col("cls") == F.col("_cls"))
    rows = rows.select("leaf", "side", "cls", "sketch").repartition("leaf").sortWithinPartitions("leaf", "cls")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for _, rows in groups(batches, "leaf"):
            names, sides = rows.column("cls").to_pylist(), rows.column("side").to_numpy()
            tokens = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            joined = Joined(len(names))
            for i in range(len(names) - 1):
                agree = (tokens[i + 1 :] == tokens[i]).sum(axis=1) >= least
                agree &= (sides[i] == 2) | (sides[i + 1 :] != sides[i])
                for j in np.flatnonzero(agree):
                    joined.join(i, i + 1 + int(j))
            found += [(names[joined.root(i)], names[i]) for i in range(len(names)) if joined.root(i) != i]
            if len(found) > 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)

    return rows.mapInArrow(compare, "a binary, b binary")


def _edges(found):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])


def verified(rows: DataFrame, classes: DataFrame, groups_of: DataFrame, gram: int, threshold: float) -> DataFrame:
    """``cls, root, n_links``, a row for each tile a set is in: links found there,
    and the least set it hangs together with."""
    members = classes.join(groups_of, F.col("cls") == F.col("node")).select("cls", "first", "n_grams", "component")
    sizes = members.groupBy(F.col("component").alias("_component")).agg(
        F.sum("n_grams").alias("_grams"), F.count(F.lit(1)).alias("_sets")
    )
    tiles = F.ceil(F.greatest(F.col("_grams") / TILE_GRAMS, F.col("_sets") / TILE_SETS)).cast("int")
    placed = members.join(sizes, F.col("component") == F.col("_component")).withColumn("_t", tiles)
    placed = placed.withColumn("_mine", F.pmod(F.xxhash64("cls"), F.col("_t")).cast("int"))
    # The text of one row of each class; rows repeated in full bring it twice.
    fetched = rows.join(
        placed.select("cls", "component", "_t", "_mine", F.col("first.doc").alias("_doc"), F.col("first.version").alias("_version")),
        (F.col("version") == F.col("_version")) & F.col("doc").eqNullSafe(F.col("_doc")),
    )
    pairs = fetched.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_t") - 1))).select(
        F.xxhash64("component", F.least("_mine", "_other"), F.greatest("_mine", "_other")).alias("tile"),
        F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1).alias("side"),
        "cls",
        "text",
    )
    pairs = pairs.repartition("tile").sortWithinPartitions("tile", "cls")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_out, roots, links = [], [], []
        for _, rows in groups(_as_sets(batches, gram), "tile"):
            names, sides = rows.column("cls").to_pylist(), rows.column("side").to_numpy()
            sets = [np.frombuffer(b, U64) for b in rows.column("grams").to_pylist()]
            alone = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
            names, sides, sets = [names[i] for i in alone], sides[alone], [sets[i] for i in alone]
            linked, joined = similar(sets, sides, threshold)
            names_out += names
            roots += [names[joined.root(i)] for i in range(len(names))]
            links += linked.tolist()
            if len(names_out) > 20_000:
                yield _found(names_out, roots, links)
                names_out, roots, links = [], [], []
        if names_out:
            yield _found(names_out, roots, links)

    return pairs.mapInArrow(compare, "cls binary, root binary, n_links long")


def _found(names, roots, links):
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.binary()), pa.array(roots, pa.binary()), pa.array(links, pa.int64())], ["cls", "root", "n_links"]
    )


def _as_sets(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Batches with the n-gram set in place of the text."""
    for batch in batches:
        sets = [gram_set(plain_word_hashes(t), gram).tobytes() for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("tile"), batch.column("side"), batch.column("cls"), pa.array(sets, pa.large_binary())],
            ["tile", "side", "cls", "grams"],
        )


def similar(sets: list[np.ndarray], sides: np.ndarray, threshold: float) -> tuple[np.ndarray, Joined]:
    """Links of each set of a tile, and which sets hang together, exactly.

    Shared n-grams are columns of a 0/1 matrix; its products are the sizes of
    all intersections, a band of columns at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    joined, linked = Joined(n), np.zeros(n, np.int64)
    if n < 2:
        return linked, joined
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = times[column] > 1
    numbers = np.cumsum(times > 1) - 1
    column, owner = numbers[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    band = max(256, min(4096, (8 << 20) // (4 * n)))
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, band):
        a, b = np.searchsorted(column, [at, at + band])
        held = np.zeros((n, min(band, last - at)), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    pairs = (common > 0) & (common >= np.float64(threshold) * union - 1e-6)
    np.fill_diagonal(pairs, False)
    pairs &= (sides[:, None] == 2) | (sides[:, None] != sides[None, :])
    for i in range(n):
        for j in np.flatnonzero(pairs[i, i + 1 :]):
            joined.join(i, i + 1 + int(j))
    return pairs.sum(axis=1), joined


def join_similar(
    documents: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    gram: int = GRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """``doc, version, class_id, n_copies, n_links, is_first`` of every row.

    ``class_id`` is the least key of all documents linked with it, by any number
    of steps; ``n_copies`` counts the other rows with the same words, and
    ``n_links`` the other texts, by words, of at least the given similarity.
    ``is_first`` holds for one version of one document of each class. Words are
    in lower case and without punctuation. A text of fewer than ``gram`` words
    has no n-grams and links with none but its copies; a null text is empty.
    Null keys are never the least, unless a class has no other. ``version``
    tells the texts of one key apart. No documents: no rows.
    """
    rows = _documents(documents, text, key)
    sets = staged(find_sets(rows, gram), "sets")
    # Copies shrink to one row per map task; a null key counts as the last.
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "version", "n_grams", "sketch")
    classes = sets.groupBy("cls").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n_rows"))
    classes = staged(classes.select("cls", "first", "n_rows", "first.n_grams", "first.sketch"), "classes")
    comparable = classes.where("n_grams > 0")
    leaves = find_leaves(comparable, runs_for(recall, threshold))
    hanging = components(sketch_edges(leaves, comparable, threshold), "hanging")
    links = staged(verified(rows, comparable, hanging, gram, threshold), "links")
    linked = links.groupBy(F.col("cls").alias("_linked")).agg(F.sum("n_links").alias("n_links"))
    exact = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")), "exact")
    named = classes.join(linked, F.col("cls") == F.col("_linked"), "left").join(exact, F.col("cls") == F.col("node"), "left")
    named = named.select(
        "cls", "first", "n_rows", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "cls").alias("component")
    )
    heads = named.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("head"))
    facts = named.join(heads, F.col("component") == F.col("_component")).select(
        F.col("cls").alias("_cls"), "n_rows", "n_links", F.col("head.doc").alias("class_id"), F.col("head.version").alias("_head")
    )
    out = sets.join(facts, F.col("cls") == F.col("_cls"))
    return out.select(
        "doc",
        "version",
        "class_id",
        (F.col("n_rows") - 1).alias("n_copies"),
        "n_links",
        (F.col("doc").eqNullSafe(F.col("class_id")) & (F.col("version") == F.col("_head"))).alias("is_first"),
    )


def keep_first(
    documents: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    gram: int = GRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One document of each group of linked ones, with its columns as they are.

    It is the one that :func:`join_similar` marks as first; of rows repeated in
    full, one stays.
    """
    first = join_similar(documents, text, key, gram, threshold, recall).where("is_first")
    first = first.select(F.col("doc").alias("_doc"), F.col("version").alias("_first")).distinct()
    rows, names = hidden(documents)
    body, own = names[text], names[key]
    rows = rows.withColumn("_version", F.xxhash64(body))
    kept = rows.join(first, (F.col("_version") == F.col("_first")) & F.col(own).eqNullSafe(F.col("_doc")))
    turn = F.row_number().over(Window.partitionBy("_version", own).orderBy(body))
    kept = kept.withColumn("_turn", turn).where("_turn = 1")
    return kept.select(*[F.col(given).alias(c) for c, given in names.items()])
