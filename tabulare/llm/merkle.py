"""A Merkle tree over the rows of a table, and for every row a proof that leads to the root by pointer jumping.

Each row is a leaf; per source the leaves have a tree of their own, whose root
is a leaf of one more tree over the sources. ``FANOUT`` consecutive nodes have
one parent. A node's segment holds its siblings, to the left and to the right,
for every step up to the ancestor that its pointer names. Joining the nodes
with themselves, pointer to node, doubles that distance and puts the segments
one after the other, until all pointers have passed the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulare.llm.numbering import numbered
from tabulare.session import work_table

FANOUT = 16
TOP = "^"  # the tree over the sources; a source's own begins with "=" or is empty
HELD_KEYS = 65_536
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """A value as it goes into a digest: its length in bytes and itself, so that no two rows read the same; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def tampered_text(key: Column, text: Column) -> Column:
    """The text, with A-Z in lower case in every fifth document or so, as picked by a checksum of the key."""
    picked = F.crc32(key.cast("string").cast("binary")) % 5 == 0
    return F.when(picked, F.translate(text, LETTERS, LETTERS.lower())).otherwise(text)


def leaves(docs: DataFrame, columns: list[str], key: str, source: str, text: str) -> DataFrame:
    """Per row ``_id``, ``_t`` (its source), ``_leaf`` and ``_changed``, the leaf after tampering."""
    values = [field(F.col(f"`{name}`")) for name in columns]
    changed = [
        field(tampered_text(F.col(key), F.col(text))) if name == text else value for name, value in zip(columns, values, strict=True)
    ]
    return docs.select(
        F.col(key).cast("bigint").alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("_t"),
        digest(*values).alias("_leaf"),
        digest(*changed).alias("_changed"),
    )


def node_key(tree: Column, level: Column, index: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), index.cast("string"), tree)


def above(n: Column) -> Column:
    return F.ceil(n / FANOUT).cast("bigint")


def grow(nodes: DataFrame) -> list[DataFrame]:
    """All levels over ``nodes`` (``_t``, ``_i``, ``_d``, ``_n``: tree, index, digest, nodes on the level), lowest first.

    A row per parent: the same columns, its ``_level``, and ``_members``, the
    digests of its children in order, ``FANOUT`` at most.
    """
    levels: list[DataFrame] = []
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while most > 1:
        run = F.floor(F.col("_i") / FANOUT).cast("bigint")
        members = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_d"))), lambda m: m["_d"])
        parents = (
            nodes.where("_n > 1")
            .groupBy("_t", run.alias("_run"))
            .agg(members.alias("_members"), above(F.first("_n")).alias("_n"))
            .select("_t", F.col("_run").alias("_i"), digest(joined(F.col("_members"))).alias("_d"), "_n",
                    F.lit(len(levels) + 1).cast("bigint").alias("_level"), "_members")
        )
        nodes = work_table(parents, "level")
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def beside(members: Column, place: Column) -> Column:
    """The siblings at a place of a run: what stands to the left of it and to the right."""
    left, right = F.slice(members, F.lit(1), place), F.slice(members, place + 2, F.lit(FANOUT))
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def jump(nodes: DataFrame) -> DataFrame:
    """Nodes (``_key``, ``_ptr``, ``_sub``, ``_path``) whose pointers have passed the root, each with its whole path.

    ``_sub`` is the digest of the source's root, once the path has come to it.
    After a few rounds many nodes point to a few: an ancestor is repeated under
    as many salts as keep the nodes of one at about ``HELD_KEYS``.
    """
    done, rest, distance = [], nodes, 1
    while True:
        done.append(rest.where(F.col("_ptr").isNull()))
        rest = rest.where(F.col("_ptr").isNotNull())
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
        salts = max(1, min(FANOUT ** min(distance, 10), rest.count()) // HELD_KEYS)
        targets = reduce(DataFrame.unionByName, [*done, rest])
        if distance > 1:  # the nodes that are pointed to get fewer with each round
            targets = targets.join(rest.select(F.col("_ptr").alias("_key")).distinct(), "_key", "left_semi")
        targets = targets.select(
            F.col("_key").alias("_k"), F.col("_ptr").alias("_p"), F.col("_sub").alias("_s"), F.col("_path").alias("_more"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_k"),
        )
        salt = F.pmod(F.xxhash64("_key"), F.lit(salts)).cast("int")
        moved = rest.withColumn("_salt", salt).join(targets, (F.col("_ptr") == F.col("_k")) & (F.col("_salt") == F.col("_salt_k")))
        rest = work_table(
            moved.select(
                "_key", F.col("_p").alias("_ptr"), F.coalesce("_sub", "_s").alias("_sub"), F.concat("_path", "_more").alias("_path")
            ),
            "jumped",
        )
        distance *= 2


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``, and ``path``, its proof.

    Leaves stand in order of source (null first), key (null first) and digest,
    so repeated rows and keys have a place each. ``path`` holds the siblings to
    the left and right for each step from the leaf to the root; folding the
    leaf, tampered with where ``tampered_text`` says so, with it must give the
    root. A table of one row has its leaf as root and an empty path; an empty
    table gives no rows. Texts are read once and hashed where they are read;
    only digests move. Columns beyond ``columns`` do not count.
    """
    hashed = work_table(leaves(docs, list(columns), key, source, text), "hashed")
    rows = work_table(numbered(hashed, ["_t", "_id", "_leaf"]), "leaves")
    trees = rows.groupBy("_t").agg(F.min("_place").alias("_start"), F.count("*").alias("_n"))
    trees = work_table(numbered(trees, ["_t"], "_rank"), "trees")
    sources = trees.count()
    of_tree = trees.withColumnRenamed("_t", "_tree")
    placed = work_table(
        rows.join(of_tree, F.col("_t") == F.col("_tree")).withColumn("_i", F.col("_place") - F.col("_start")).drop("_tree", "_start", "_place"),
        "placed",
    )
    own = grow(placed.select("_t", "_i", F.col("_leaf").alias("_d"), "_n"))
    subroots = reduce(
        DataFrame.unionByName, [placed.where("_n = 1").select("_t", F.col("_leaf").alias("_d")), *(level.where("_n = 1").select("_t", "_d") for level in own)]
    )
    tops = subroots.join(of_tree.select("_tree", "_rank"), F.col("_t") == F.col("_tree")).select(
        F.lit(TOP).alias("_t"), F.col("_rank").alias("_i"), "_d", F.lit(sources).cast("bigint").alias("_n")
    )
    over = grow(tops)
    root = (over[-1] if over else tops).select("_d").first()

    inner = _inner(own, over, of_tree, sources)
    if inner is None:  # a row at most
        found = placed.withColumns(
            {"_sub": F.col("_leaf"), "_path": F.array().cast("array<struct<left: string, right: string>>")}
        )
    else:
        lone = F.col("_n") == 1
        up = F.when(lone, node_key(F.lit(TOP), F.lit(1), F.floor(F.col("_rank") / FANOUT))).otherwise(
            node_key(F.col("_t"), F.lit(1), F.floor(F.col("_i") / FANOUT))
        )
        place = F.pmod(F.when(lone, F.col("_rank")).otherwise(F.col("_i")), F.lit(FANOUT)).cast("int")
        known = inner.select(F.col("_key").alias("_k"), F.col("_sub").alias("_s"), "_members", F.col("_path").alias("_more"))
        found = placed.withColumn("_up", up).join(known, F.col("_up") == F.col("_k")).select(
            "_id", "_leaf", "_changed",
            F.when(lone, F.col("_leaf")).otherwise(F.col("_s")).alias("_sub"),
            F.concat(F.array(beside(F.col("_members"), place)), "_more").alias("_path"),
        )
    siblings = F.flatten(F.transform("_path", lambda step: F.array(step["left"], step["right"])))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("_leaf").alias("leaf"),
        F.col("_sub").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        digest(joined(siblings)).alias("proof_sha256"),
        fold(F.col("_changed"), F.col("_path")).alias("folded_root"),
        F.col("_path").alias("path"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def _inner(own: list[DataFrame], over: list[DataFrame], of_tree: DataFrame, sources: int) -> DataFrame | None:
    """All nodes but the leaves: ``_key``, ``_members``, ``_sub`` and ``_path``, the whole way from the node to the root."""
    if not own and not over:
        return None
    parts = []
    for level in own:
        parts.append(level.join(of_tree.select("_tree", "_rank"), F.col("_t") == F.col("_tree")).drop("_tree"))
    for level in over:
        parts.append(level.withColumn("_rank", F.lit(None).cast("bigint")))
    nodes = reduce(DataFrame.unionByName, parts)
    last, is_source = F.col("_n") == 1, F.col("_t") != TOP
    up = (
        F.when(~last, node_key(F.col("_t"), F.col("_level") + 1, F.floor(F.col("_i") / FANOUT)))
        .when(is_source & F.lit(sources > 1), node_key(F.lit(TOP), F.lit(1), F.floor(F.col("_rank") / FANOUT)))
    )
    place = F.pmod(F.when(last, F.col("_rank")).otherwise(F.col("_i")), F.lit(FANOUT)).cast("int")
    nodes = work_table(
        nodes.select(
            node_key(F.col("_t"), F.col("_level"), F.col("_i")).alias("_key"), up.alias("_ptr"), place.alias("_at"),
            F.when(last & is_source, F.col("_d")).alias("_sub"), "_members",
        ),
        "nodes",
    )
    runs = nodes.select(F.col("_key").alias("_k"), F.col("_members").alias("_run"))
    linked = nodes.drop("_members").join(runs, F.col("_ptr") == F.col("_k"), "left")
    step = F.array(beside(F.col("_run"), F.col("_at")))
    path = F.when(F.col("_k").isNull(), F.array().cast("array<struct<left: string, right: string>>")).otherwise(step)
    pointed = work_table(linked.select("_key", "_ptr", "_sub", path.alias("_path")), "pointed")
    return jump(pointed).join(nodes.select(F.col("_key").alias("_own"), "_members"), F.col("_key") == F.col("_own")).drop("_own", "_ptr")
