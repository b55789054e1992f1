"""A Merkle manifest of a table: content-addressed nodes, and proofs by descent from the root.

1. Every row is a leaf, the digest of its fields. Leaves of one group (a language, a source) are ranked by
   their key; eight consecutive nodes have one parent, whose digest is that of its children's, until one node
   is left. The groups' last nodes are joined in the same way into the root.
2. The store holds one record for each different digest: its children in order. Equal subtrees share a record.
3. Requests for leaves descend from the root by the digits of their ranks to the base eight. Requests whose
   digits are equal so far travel as one row, so a level has no more rows than nodes asked for and no
   node is a hot key. At each level the row joins the record of its digest, and the children that were not chosen
   become one segment of the path. A leaf's path, reversed, is its proof.
4. A row as it is found later is folded with its proof; it is verified if the result is the root.

Texts are read once and never shuffled; what is shuffled has fixed-size rows. Ranks come from a range sort and
a running sum, so a group with most of the rows is spread like any other. All is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.operators.numbering import number_rows
from ferryline.runtime import materialize

#: Children of a node.
WIDTH = 8
#: Groups that may be broadcast (about 100 bytes each); more of them are joined by a shuffle.
FEW_GROUPS = 50_000


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``group``, ``key``, ``leaf``, ``found``, ``number`` of the group and ``rank`` in it; ``groups``:
    ``number``, ``group``, ``height``; ``nodes``: ``digest``, ``children``. ``root`` is None for a table without rows."""

    leaves: DataFrame
    groups: DataFrame
    nodes: DataFrame
    root: str | None
    height: int
    deepest: int


def fields_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of values one after the other: ``-`` for NULL, else length in UTF-8, ``:`` and the value."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256)


def digests(children: Column) -> Column:
    """SHA-256 of digests one after the other, as hexadecimal text."""
    return F.sha2(F.array_join(children, "").cast("binary"), 256)


def _height(count: Column) -> Column:
    """Levels above ``count`` nodes: the least h with 8 ** h >= count, in whole numbers."""
    powers = F.array(*[F.lit(WIDTH**h).cast("long") for h in range(21)])
    return F.size(F.filter(powers, lambda p: p < count))


def _levels(nodes: DataFrame, count: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of parents, level by level, and the last nodes. ``nodes``: ``number``, ``rank``, ``digest``, ``n``, the group's nodes."""
    levels, last = [], [nodes.where("n = 1")]
    while count > 1:
        child = F.struct("rank", "digest")
        parents = nodes.where("n > 1").groupBy("number", F.expr(f"rank div {WIDTH}").alias("rank"), F.expr(f"(n + {WIDTH - 1}) div {WIDTH}").alias("n"))
        parents = parents.agg(F.transform(F.sort_array(F.collect_list(child)), lambda c: c["digest"]).alias("children"))
        nodes = materialize(parents.withColumn("digest", digests(F.col("children"))), label)
        levels.append(nodes)
        last.append(nodes.where("n = 1"))
        count = -(-count // WIDTH)
    lone = last[0].select("number", "digest")
    for some in last[1:]:
        lone = lone.unionByName(some.select("number", "digest"))
    return levels, lone


def build(rows: DataFrame, key: str, group: str, fields: Sequence[str], found: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``: leaves are digests of ``fields``, ranked by ``key`` within ``group``, NULL first.

    Rows with equal keys in one group follow the order of their digests. ``found`` gives other expressions for some fields,
    as a later reader finds them; their digest is kept beside the leaf. Other columns do not matter, whatever their names.
    """
    now = dict(found or {})
    leaves = rows.select(
        F.col(group).cast("string").alias("group"),
        F.col(key).alias("key"),
        fields_digest([F.col(f) for f in fields]).alias("leaf"),
        fields_digest([now.get(f, F.col(f)) for f in fields]).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )
    # The row number keeps equal rows apart in the range sort, which could not split them otherwise.
    placed = materialize(number_rows(materialize(leaves, "leaves"), ["group", "key", "leaf", "row"], "position").drop("row"), "ranked")
    groups = placed.groupBy("group").agg(F.min("position").alias("start"), F.count("*").alias("n"))
    groups = materialize(number_rows(groups.withColumn("height", _height(F.col("n"))), ["group"], "number"), "groups")
    size = groups.agg(F.count("*").alias("groups"), F.max("n").alias("most"), F.max("height").alias("height")).first()
    few = F.broadcast(groups) if size["groups"] <= FEW_GROUPS else groups
    ranked = placed.join(few.withColumnRenamed("group", "g"), F.col("group").eqNullSafe(F.col("g"))).withColumn("rank", F.col("position") - F.col("start"))
    ranked = materialize(ranked.select("group", "key", "leaf", "found", "number", "rank", "n"), "manifest-leaves")
    inner, lone = _levels(ranked.select("number", "rank", F.col("leaf").alias("digest"), "n"), size["most"] or 0, "nodes")
    top = lone.select(F.lit(0).cast("long").alias("number"), F.col("number").alias("rank"), "digest", F.lit(size["groups"]).cast("long").alias("n"))
    outer, last = _levels(materialize(top, "tops"), size["groups"], "nodes")
    nodes = None
    for level in [*inner, *outer]:
        own = level.select("digest", "children")
        nodes = own if nodes is None else nodes.unionByName(own)
    if nodes is None:
        nodes = rows.sparkSession.createDataFrame([], "digest string, children array<string>")
    nodes = materialize(nodes.groupBy("digest").agg(F.first("children").alias("children")), "manifest-nodes")
    root = last.first()
    return Manifest(ranked, few.select("number", "group", "height"), nodes, root and root["digest"], len(outer), size["height"] or 0)


def _descend(frontier: DataFrame, nodes: DataFrame) -> DataFrame:
    """One level down: each row becomes one for each child, with what was not chosen as a new segment of the path."""
    known = frontier.join(nodes, "digest")
    others = [c for c in frontier.columns if c not in ("digest", "prefix", "path")]
    child = known.select(*others, "prefix", "path", "children", F.posexplode("children").alias("digit", "digest"))
    return child.select(*others, "digest", (F.col("prefix") * WIDTH + F.col("digit")).alias("prefix"), F.concat("path", F.array(segment("children", "digit"))).alias("path"))


def segment(children: str, digit: str) -> Column:
    """The digests left and right of a chosen child, each side as one text."""
    left = F.array_join(F.slice(children, F.lit(1), F.col(digit)), "")
    right = F.array_join(F.slice(children, F.col(digit) + 2, F.lit(WIDTH)), "")
    return F.struct(left.alias("left"), right.alias("right"))


_SEGMENTS = "array<struct<left:string,right:string>>"


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (``number`` and ``rank`` of leaves, and any columns but those below) with ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``proof`` lists the segments from the leaf up to the root. Requests of unknown leaves give no row.
    """
    spark = requests.sparkSession
    given = [c for c in requests.columns if c not in ("number", "rank")]
    asked = requests.select("number", "rank", F.struct(F.col("rank"), *given).alias("request")) if given else requests.select("number", "rank", F.struct("rank").alias("request"))
    heights = manifest.groups.select("number", "height")
    asked = asked.join(heights, "number")
    packs = materialize(
        asked.groupBy("number", F.when(F.col("height") > 0, F.expr(f"rank div {WIDTH}")).otherwise(F.col("rank")).alias("prefix"), "height").agg(F.collect_list("request").alias("requests")),
        "requests",
    )
    # Prefixes asked for at each level of the groups, one table a level, from the leaves' parents up.
    wanted = [packs.select("number", "prefix", "height")]
    for level in range(2, manifest.deepest + 1):
        above = wanted[-1].where(F.col("height") >= level).select("number", F.expr(f"prefix div {WIDTH}").alias("prefix"), "height")
        wanted.append(materialize(above.distinct(), "wanted"))
    start = spark.range(1 if manifest.root else 0).select(
        F.lit(manifest.root).alias("digest"), F.lit(0).cast("long").alias("prefix"), F.expr(f"CAST(array() AS {_SEGMENTS})").alias("path")
    )
    frontier = start
    for _ in range(manifest.height):
        frontier = materialize(_descend(frontier, manifest.nodes), "descent")
    tops = frontier.select(F.col("prefix").alias("number"), F.col("digest").alias("subroot"), "digest", F.lit(0).cast("long").alias("prefix"), "path")
    tops = tops.join(heights, "number")
    tops = tops.join(packs.select("number").distinct(), "number", "left_semi")
    frontier = materialize(tops.where("height > 0"), "descent")
    arrived = tops.where("height = 0")
    for level in range(manifest.deepest, 1, -1):
        # Groups of this height join on the way down.
        going, waiting = frontier.where(F.col("height") >= level), frontier.where(F.col("height") < level)
        down = _descend(going, manifest.nodes).join(wanted[level - 2].select("number", "prefix"), ["number", "prefix"], "left_semi")
        frontier = materialize(down.unionByName(waiting), "descent")
    parents = frontier.join(manifest.nodes, "digest").join(packs.select("number", "prefix", "requests"), ["number", "prefix"])
    whole = parents.select("subroot", "path", "children", F.explode("requests").alias("request"))
    whole = whole.withColumn("digit", F.expr(f"CAST(request.rank % {WIDTH} AS INT)")).where(F.col("digit") < F.size("children"))
    leaves = whole.select(
        "request", F.element_at("children", F.col("digit") + 1).alias("leaf"), "subroot", F.concat("path", F.array(segment("children", "digit"))).alias("path")
    )
    single = arrived.join(packs.select("number", "requests"), "number").select("subroot", "path", F.explode("requests").alias("request"))
    leaves = leaves.unionByName(single.where("request.rank = 0").select("request", F.col("subroot").alias("leaf"), "subroot", "path"))
    return leaves.select(*[F.col("request").getField(c).alias(c) for c in given], "leaf", "subroot", F.lit(manifest.root).alias("root"), F.reverse("path").alias("proof"))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all digests of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]).cast("binary"), 256))


def verify(manifest: Manifest) -> DataFrame:
    """Every leaf's ``key``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` of the row as found, and ``verified``."""
    proven = proofs(manifest, manifest.leaves.select("number", "rank", "key", "found"))
    folded = proven.withColumn("folded_root", fold(F.col("found"), F.col("proof")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root")).drop("found")
