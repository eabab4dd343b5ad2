"""A Merkle manifest of a dataset: one root, and for every row a proof that it belongs to it.

Every group of rows (a source) is a tree with its rows in id order as leaves; the groups' roots
are the leaves of the tree above. A level of all trees is built at once by a pivot: nodes are
grouped by parent, conditional aggregates put the children into ``fanout`` slot columns, and
the columns hashed together are the parent. The same columns without a child's own slot are
that child's siblings, so proofs are read off the pivots from the top down, one join by parent
a level; rows are never compared with each other.

Places of leaves come from sorting by range: a task numbers its own rows, and the sums of what
the tasks before it hold of the same group are added. A group of any size is spread over as
many tasks as its rows fill.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.llm.common import fold, lower_ascii
from entiva.session import Workspace

#: A step of a proof: the digests of the siblings before and after a node, as text.
STEP = "struct<before: string, after: string>"


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def sort_rows(
    rows: DataFrame, order: list[str], group: str, workspace: Workspace, label: str
) -> tuple[DataFrame, DataFrame]:
    """``rows`` (a written table) in ``order``, and where each task's stretch of a group starts.

    Rows equal in ``order`` follow their column ``input``. ``order`` begins with ``group``, so
    a task holds a stretch of one group or of several. The starts have one row per stretch:
    ``of, within`` (group and task), ``shift`` (what to add to a row's number to get its place
    in the group) and ``members`` (the rows of the whole group).
    """
    spread = rows.repartitionByRange(*order, "input").sortWithinPartitions(*order, "input")
    bits = 33  # row numbers have the task above these bits
    placed = workspace.keep(
        spread.drop("input").withColumn("row", F.monotonically_increasing_id()), f"{label}-sorted"
    ).withColumn("task", F.shiftright("row", bits))
    stretches = placed.groupBy(group, "task").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # a group has as many rows here as tasks hold some of it
    own = Window.partitionBy(group)
    before = own.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        F.col(group).alias("of"),
        F.col("task").alias("within"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(own).alias("members"),
    )
    return placed, workspace.keep(starts, f"{label}-starts")


def with_places(placed: DataFrame, starts: DataFrame, group: str) -> DataFrame:
    """Sorted rows with the columns of their group's start and their ``place`` from 0."""
    here = (F.col("task") == F.col("within")) & F.col(group).eqNullSafe(F.col("of"))
    return (
        placed.join(starts, here)
        .withColumn("place", F.col("row") + F.col("shift"))
        .drop("row", "task", "of", "within", "shift")
    )


def _slots(fanout: int) -> list[str]:
    return [f"slot{i}" for i in range(fanout)]


def pivot(nodes: DataFrame, fanout: int, child: Column) -> DataFrame:
    """One row per parent: its tree and place, the nodes of its level, its children in slots.

    ``nodes`` has ``tree, place, members``; ``child`` is a struct with the field ``node``.
    """
    slot = F.col("place") % fanout
    children = [
        F.max(F.when(slot == i, child)).alias(name) for i, name in enumerate(_slots(fanout))
    ]
    parent = F.floor(F.col("place") / fanout).alias("place")
    above = F.ceil(F.max("members") / fanout).cast("long").alias("members")
    digest = F.sha2(F.concat_ws("", *[F.col(f"{name}.node") for name in _slots(fanout)]), 256)
    return nodes.groupBy("tree", parent).agg(above, *children).withColumn("node", digest)


def siblings(fanout: int, own: int) -> Column:
    """The step of the child in slot ``own``: all slots but its own."""
    names = _slots(fanout)
    before, after = names[:own], names[own + 1 :]
    return F.struct(
        F.concat_ws("", *[F.col(f"{n}.node") for n in before]).alias("before"),
        F.concat_ws("", *[F.col(f"{n}.node") for n in after]).alias("after"),
    )


def children_of(parents: DataFrame, fanout: int, payload: list[str], passed: list[str]):
    """One row per child with its ``payload`` (fields of the slots), its ``place`` and its
    ``path``: its own siblings, then the path of its parent. ``passed`` columns come along."""
    each = [
        F.struct(
            (F.col("place") * fanout + i).alias("place"),
            *[F.col(f"{name}.{f}").alias(f) for f in payload],
            F.concat(F.array(siblings(fanout, i)), F.col("path")).alias("path"),
            F.col(name).isNotNull().alias("there"),
        )
        for i, name in enumerate(_slots(fanout))
    ]
    return (
        parents.select(*passed, F.inline(F.array(*each))).filter("there").drop("there")
    )


def climb(nodes: DataFrame, fanout: int, payload: list[str], workspace: Workspace, label: str):
    """All levels above ``nodes`` (``tree, place, members, node`` and ``payload``): the pivots
    from the lowest up, and the single nodes that remain, one per tree that has two or more."""
    levels: list[DataFrame] = []
    tops: list[DataFrame] = []
    nodes = nodes.filter("members > 1")
    while True:
        fields = payload if not levels else ["node"]
        level = workspace.keep(
            pivot(nodes, fanout, F.struct(*fields)), f"{label}-level-{len(levels)}"
        )
        most = level.agg(F.max("members")).first()[0]
        if most is None:
            return levels, tops
        levels.append(level)
        tops.append(level.filter("members = 1").select("tree", "node"))
        if most == 1:
            return levels, tops
        nodes = level.filter("members > 1").select("tree", "place", "members", "node")


def descend(
    levels: list[DataFrame],
    tops: DataFrame,
    fanout: int,
    payload: list[str],
    passed: list[str],
    workspace: Workspace,
    label: str,
) -> DataFrame:
    """The children of the lowest level with their paths. ``tops`` has ``tree``, the ``passed``
    columns and ``path``, the steps from a tree's single node to the root."""
    columns = ["tree", *passed]
    found = None
    for number in reversed(range(len(levels))):
        level = levels[number]
        ends = level.filter("members = 1").join(tops, "tree")
        if found is not None:
            inner = level.filter("members > 1").join(found, ["tree", "place"])
            ends = ends.unionByName(inner)
        fields = payload if not number else ["node"]
        found = children_of(ends, fanout, fields, columns)
        if number:
            found = workspace.keep(found.drop("node"), f"{label}-paths-{number}")
    return found


def manifest(
    documents: DataFrame,
    fields: list[str] | None = None,
    id_column: str = "doc_id",
    group_column: str = "source",
    text_column: str = "text",
    fanout: int = 16,
    tampered: Column | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, and
    ``path``, the proof itself: for each level the siblings before and after.

    A leaf is the SHA-256 of all ``fields``, null ones marked as such. Leaves ascend by id
    within their group (null ids first, equal ids by leaf, so repeated rows are leaves of
    their own and a very common id is split like any other range), groups by their name (null
    first). A group of one row is its own root. Where ``tampered`` holds, ``folded_root`` starts
    from the leaf of the row with its text in lower case; ``verified`` tells whether it is
    still the root. Empty texts are hashed like any other, an empty table gives no rows, and
    columns beside ``fields`` are ignored, whatever they are called.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    fields = fields or [id_column, group_column, "lang", "n_chars", text_column]
    own = [F.col(f) for f in fields]
    lowered = [lower_ascii(F.col(f)) if f == text_column else F.col(f) for f in fields]
    tampered = F.lit(False) if tampered is None else tampered
    leaves = documents.select(
        F.col(group_column).alias("source"),
        F.col(id_column).alias("doc_id"),
        leaf(own).alias("node"),
        F.when(tampered, leaf(lowered)).alias("other"),
        F.monotonically_increasing_id().alias("input"),
    )
    leaves = workspace.keep(leaves, "leaves")
    order = ["source", "doc_id", "node"]
    placed, starts = sort_rows(leaves, order, "source", workspace, "rows")
    workspace.drop("leaves")
    sources = starts.select(F.col("of").alias("source")).distinct()
    sources = workspace.keep(
        sources.select("source", F.lit(0).alias("all"), F.lit(0).alias("input")), "sources"
    )
    ordered, first = sort_rows(sources, ["all", "source"], "all", workspace, "sources")
    trees = with_places(ordered, first, "all").select(
        F.col("source").alias("name"),
        F.col("place").alias("tree"),
        F.col("members").alias("trees"),
    )
    trees = workspace.keep(trees, "trees")
    same = F.col("of").eqNullSafe(F.col("name"))
    nodes = workspace.keep(
        with_places(placed, starts.join(trees, same), "source").select(
            "tree", "place", "members", "doc_id", "node", "other"
        ),
        "nodes",
    )
    workspace.drop("rows-sorted")
    payload = ["doc_id", "node", "other"]
    levels, tops = climb(nodes, fanout, payload, workspace, "source")
    alone = nodes.filter("members = 1")
    subroots = reduce(DataFrame.unionByName, tops, alone.select("tree", "node"))
    total = trees.agg(F.max("trees")).first()[0] or 0
    upper = workspace.keep(
        subroots.select(
            F.lit(0).cast("long").alias("tree"),
            F.col("tree").alias("place"),
            F.lit(total).cast("long").alias("members"),
            "node",
        ),
        "subroots",
    )
    above, roots = climb(upper, fanout, ["node"], workspace, "root")
    last = roots[-1] if above else upper.select("tree", "node")
    root = last.first()  # one row: the root of all
    root = root.node if root else None
    no_steps = F.array().cast(f"array<{STEP}>")
    if above:
        top = above[-1].select("tree", no_steps.alias("path"))
        paths = descend(above, top, fanout, ["node"], [], workspace, "root")
    else:
        paths = upper.select("tree", "place", "node", no_steps.alias("path"))
    tops_of = workspace.keep(
        paths.select(F.col("place").alias("tree"), F.col("node").alias("subroot"), "path"),
        "subroot-paths",
    )
    columns = ["subroot", "doc_id", "node", "other", "path"]
    proven = alone.join(tops_of, "tree").select(*columns)
    if levels:
        below = descend(levels, tops_of, fanout, payload, ["subroot"], workspace, "source")
        proven = proven.unionByName(below.select(*columns))
    folded = F.aggregate(
        "path",
        F.coalesce("other", "node"),
        lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256),
    )
    steps = F.transform("path", lambda step: F.concat(step["before"], step["after"]))
    return proven.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        "path",
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(id_column: str = "doc_id") -> Column:
    """Rows whose id, in decimal digits, has a crc32 that 5 divides; a null id is no digits."""
    return fold(id_column, 5) == 0
