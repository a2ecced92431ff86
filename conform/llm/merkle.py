"""Merkle manifest of a dataset: a content-addressed store of digests and their children, and proofs by descent.

Every document is a leaf, the digest of its columns. The leaves of a group (its language) in order form a tree in which each
run of ``FAN`` nodes has their joint digest as parent; the groups' subroots in order form a last tree with the root.
Digests are SHA-256 over lowercase hex text; tables hold them as 32 bytes.

The store has one record a distinct digest and height: digest -> children. A proof starts at the root and goes down by the
digits of the leaf's rank (to the base ``FAN``): each step looks a digest up, takes the child at the digit and collects the
others. All leaves below a node share the way down to it, so a step carries one row a node, not one a leaf, and the
segments of the path are read backwards (leaf to root) at the end only. Every step is a join on the digest whose
sides shrink by ``FAN`` from height to height.

Ranks are positions in a range-partitioned order; no task sees a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import ascii_lower, gathered, spread_join, staged
from conform.session import scratch_path

FAN = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BYTES = 32
LEVEL_ROWS = 200_000  # nodes of a level in a file


def digest(*parts: Column) -> Column:
    """SHA-256 (32 bytes) of digests joined as lowercase hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(*parts))), 256))


def hex_of(c: Column) -> Column:
    return F.lower(F.hex(c))


def leaf_digest(columns: Sequence[str] = LEAF_COLUMNS, changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row: each column as ``-`` if null, else its byte count, a colon and its value; ``changed`` replaces values."""
    parts = []
    for c in columns:
        value = (changed or {}).get(c, F.col(c)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(spark: SparkSession, rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Rows with their position ``at`` in the group (from 0) and the group's ``size``. Nulls come first.

    Rows are sorted in range partitions and written with the partition and a number that rises inside it; a group's rows in earlier
    partitions are counted from one row a (group, partition), which is also the key of the join that adds the count: no group makes it
    hot. Rows that are equal in ``order`` share a range; their order is of no account.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = (rows.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumns({"__part": F.spark_partition_id(), "__n": F.monotonically_increasing_id()}))
    placed = staged(spark, placed, name, rows.count())
    held = placed.groupBy(group, "__part").agg(F.min("__n").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    earlier = F.coalesce(F.sum("n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select(F.col(group).alias("__group"), F.col("__part").alias("__in"), (earlier - F.col("first")).alias("__shift"),
                       F.sum("n").over(whole).alias("size"))
    held = staged(spark, held, f"{name}-shifts", 1)
    out = placed.join(held, (placed["__part"] == held["__in"]) & placed[group].eqNullSafe(held["__group"]))
    return out.withColumn("at", F.col("__n") + F.col("__shift")).drop("__part", "__n", "__in", "__group", "__shift")


def height_of(size: int) -> int:
    """Levels above a group's leaves: a lone leaf is its own subroot."""
    h = 0
    while size > 1:
        size, h = -(-size // FAN), h + 1
    return h


@dataclass(frozen=True)
class Trees:
    """Stored trees of groups: ``path/height=h`` holds (group, at, size, digest, children) of every node that has children."""

    spark: SparkSession
    path: str
    group: str
    most: int               # the greatest height
    tops: DataFrame         # group, height, digest: a row a group
    hot: bool               # equal digests stand in so many places that a join by digest has to split them

    def store(self, h: int) -> DataFrame:
        """The records at a height: digest -> children, and in how many places it stands. Equal digests have equal children."""
        level = self.spark.read.parquet(f"{self.path}/height={h}")
        return level.groupBy("digest").agg(F.first("children").alias("children"), F.count("*").alias("held"))


def build(spark: SparkSession, leaves: DataFrame, group: str, path: str) -> Trees:
    """Trees over leaves (group, at, size, digest). Each level is grouped from the one below and written; a run has ``FAN`` rows at the most.

    A group that has come down to one node is left as it is.
    """
    known = leaves.agg(F.max("size").alias("most"), F.count("*").alias("rows")).first()
    most, rows = height_of(known["most"] or 0), known["rows"]
    below, tops, hot = leaves.select(group, "at", "size", "digest"), [], False
    for h in range(most + 1):
        # FAN^h leaves fit below one node of this height
        tops.append(below.where((F.col("size") <= FAN ** h) & (F.col("size") > (FAN ** (h - 1) if h else 0)))
                    .select(group, F.lit(h).alias("height"), "digest"))
        if h == most:
            break
        run = F.sort_array(F.collect_list(F.struct("at", F.hex("digest").alias("x"))))
        nodes = below.where(F.col("size") > FAN ** h).groupBy(group, F.shiftright("at", 3).alias("up")).agg(
            F.first("size").alias("size"), F.unhex(F.array_join(F.transform(run, lambda r: r["x"]), "")).alias("children"))
        rows = -(-rows // FAN) + 1
        gathered(nodes.select(group, F.col("up").alias("at"), "size", digest(F.col("children")).alias("digest"), "children"),
                 rows, LEVEL_ROWS).write.parquet(f"{path}/height={h + 1}")
        level = spark.read.parquet(f"{path}/height={h + 1}")
        below = level.select(group, "at", "size", "digest")
        if h == 0:  # above, nodes are equal in as large a share of the places at the most
            held = level.groupBy("digest").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
            hot = held["most"] > 1 and held["most"] * int(spark.conf.get("spark.sql.shuffle.partitions")) > held["all"]
    found = tops[0]
    for t in tops[1:]:
        found = found.unionByName(t)
    return Trees(spark, path, group, most, staged(spark, found, "merkle-tops", 1), hot)


PATH = "array<struct<taken:int,others:binary>>"


def descend(trees: Trees, start: DataFrame, wanted: dict[int, DataFrame] | None = None, carried: DataFrame | None = None) -> DataFrame:
    """From each group's top down to its leaves: (group, at, digest, top, path), and ``row`` of ``carried`` (group, at, row).

    ``start`` has (group, height, digest, path), one row a group; ``path`` gets a segment (child taken, the other children) a step.
    ``wanted[h]`` (group, at) limits the nodes that are followed at height h. What is carried joins its node of eight leaves,
    before the path is repeated for each of them.
    """
    group = trees.group

    def entering(h: int) -> DataFrame:
        return start.where(F.col("height") == h).select(group, F.lit(0).cast("long").alias("at"), "digest", F.col("digest").alias("top"), "path")

    def followed(frontier: DataFrame, h: int) -> DataFrame:
        if wanted is None:
            return frontier
        w = wanted[h].select(F.col(group).alias("__g"), F.col("at").alias("__at"))
        return frontier.join(w, (frontier["at"] == w["__at"]) & frontier[group].eqNullSafe(w["__g"]), "left_semi")

    def with_rows(frontier: DataFrame, rows: DataFrame) -> DataFrame:
        r = rows.withColumnsRenamed({group: "__g", "at": "__at"})
        return frontier.join(r, (frontier["at"] == r["__at"]) & frontier[group].eqNullSafe(r["__g"])).drop("__g", "__at")

    frontier = followed(entering(trees.most), trees.most)
    if carried is not None and trees.most == 0:
        return with_rows(frontier, carried)
    for h in range(trees.most, 0, -1):
        store, keep = trees.store(h), []
        met = spread_join(frontier, store, "digest", "held", ["at"]) if trees.hot else frontier.join(store.drop("held"), "digest")
        lone = entering(h - 1)
        if h == 1 and carried is not None:
            lists = carried.groupBy(group, F.shiftright("at", 3).alias("at")).agg(F.sort_array(F.collect_list(F.struct("at", "row"))).alias("rows"))
            met, lone, keep = with_rows(met, lists), with_rows(lone, carried.where("at = 0")), [F.col("rows")[F.col("taken")]["row"].alias("row")]
        count = (F.octet_length("children") / BYTES).cast("int")
        met = met.withColumn("taken", F.explode(F.sequence(F.lit(0), count - 1)))
        before, after = F.expr(f"substring(children, 1, taken * {BYTES})"), F.expr(f"substring(children, taken * {BYTES} + {BYTES + 1})")
        segment = F.struct("taken", F.concat(before, after).alias("others"))
        met = met.select(group, (F.col("at") * FAN + F.col("taken")).alias("at"),
                         F.expr(f"substring(children, taken * {BYTES} + 1, {BYTES})").alias("digest"), "top",
                         F.concat("path", F.array(segment)).alias("path"), *keep)
        frontier = followed(met.unionByName(lone), h - 1)
    return frontier


def fold(leaf: Column, path: Column) -> Column:
    """The root from a leaf and its path, leaf first: each segment's others go around what is known so far."""
    def step(known, s):
        cut = s["taken"] * BYTES
        return digest(F.substr(s["others"], F.lit(1), cut), known, F.substr(s["others"], cut + 1))

    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """All siblings on a path, leaf first, as lowercase hex text."""
    return F.array_join(F.transform(path, lambda s: hex_of(s["others"])), "")


@dataclass(frozen=True)
class Manifest:
    """A dataset's leaves (lang, at, size, doc_id, digest, tampered), the trees of its groups and the tree above them."""

    spark: SparkSession
    leaves: DataFrame
    groups: Trees
    places: DataFrame       # lang, height, place: a row a group
    above: Trees
    root: bytes | None      # None for an empty dataset


def manifest(docs: DataFrame, columns: Sequence[str] = LEAF_COLUMNS, group: str = "lang", tampered: Column | None = None,
             path: str | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, ``group`` and the ``columns``), its trees written below ``path`` (default: the scratch folder).

    Leaves of a group (null is one too, apart from the empty text) ascend by doc_id, null first, then by digest, so rows that
    share an id have a place as well; equal rows are equal leaves. Texts of any length are hashed whole; no other columns
    are read. ``tampered`` (a digest or null, from the row's columns) is kept beside the leaf for an audit.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "merkle")
    rows = docs.select(F.col(group).cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(columns).alias("digest"), (F.lit(None) if tampered is None else tampered).cast("binary").alias("tampered"))
    leaves = ranked(spark, staged(spark, rows, "merkle-leaves"), "lang", ("doc_id", "digest"), "merkle-ranked")
    groups = build(spark, leaves, "lang", f"{path}/groups")
    tops = groups.tops.withColumn("tree", F.lit(0))
    places = ranked(spark, tops, "tree", ("lang",), "merkle-subroots")
    above = build(spark, places.select("tree", "at", "size", "digest"), "tree", f"{path}/above")
    top = above.tops.first()
    return Manifest(spark, leaves, groups, places.select("lang", "height", F.col("at").alias("place")), above, bytes(top["digest"]) if top else None)


def proofs(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(lang, at, doc_id, leaf, tampered, subroot, root, path) of every leaf, or of those in ``requests`` (lang, at); ``path`` is leaf first.

    The descent starts at the root, so digests and siblings come from the store; the rows of the leaves add their ids. A request
    without a leaf gives no row, one that is repeated gives one.
    """
    wanted = None
    if requests is not None:
        wanted, at = {}, requests.select("lang", F.col("at").cast("long").alias("at")).distinct()
        for h in range(m.groups.most + 1):
            wanted[h] = at
            at = at.select("lang", F.shiftright("at", 3).alias("at")).distinct()
    start = m.above.tops.withColumn("path", F.array().cast(PATH))
    found = descend(m.above, start)
    at_groups = found.join(m.places, found["at"] == m.places["place"]).select("lang", "height", "digest", "path")
    at_groups = staged(m.spark, at_groups, "merkle-groups", 1)
    carried = m.leaves.select("lang", "at", F.struct("doc_id", "tampered").alias("row"))
    out = descend(m.groups, at_groups, wanted, carried)
    return out.select("lang", "at", "row.doc_id", F.col("digest").alias("leaf"), "row.tampered", F.col("top").alias("subroot"),
                      F.lit(m.root).cast("binary").alias("root"), F.reverse("path").alias("path"))


def audit(docs: DataFrame, columns: Sequence[str] = LEAF_COLUMNS, group: str = "lang", tampered: Column | None = None) -> DataFrame:
    """Every leaf's proof checked: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (digests as lowercase hex).

    ``proof_sha256`` is the digest of the siblings, leaf first. The root is folded from the ``tampered`` digest where there is
    one, else from the leaf, and the siblings; ``verified`` says whether that gives the root. One row a row of ``docs``; none for an
    empty table.
    """
    found = proofs(manifest(docs, columns, group, tampered))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", *[hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), hex_of(folded).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_text(every: int = 3) -> Column:
    """A tampered digest where ``every`` divides the CRC-32 of the decimal doc_id: the text with A-Z lowered."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(chosen, leaf_digest(changed={"text": ascii_lower(F.col("text"))}))
