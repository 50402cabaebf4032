"""Document trees as edges: paths, subtrees, page filters, edits, and documents put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.session import written


def paths(edges: DataFrame, sums: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, node, parent, depth, path: pre-order by ``path``, from roots (null parent) down, of any depth.

    edges: doc_id, node, parent, ord. Each name of ``sums`` becomes a column with the sum of its
    expression over the node's ancestors. Pointer doubling: a node's chain ends at a pointer, to which the
    pointed node's own chain is joined, so chains double and a tree of depth d takes about log2(d)
    joins, each of them written once. Nodes below a missing parent or on a circle reach no root and are left out.
    """
    sums = sums or {}
    step = F.lpad(F.col("ord").cast("string"), 12, "0")
    own = [F.coalesce(value.cast("long"), F.lit(0)).alias(f"__own_{name}") for name, value in sums.items()]
    chains = edges.select("doc_id", "node", "parent", F.col("parent").alias("up"), F.lit(0).alias("depth"), step.alias("path"), *own)
    # __all_: the sum over the chain, the node itself included.
    chains = written(chains.withColumns({f"__all_{name}": F.col(f"__own_{name}") for name in sums}), "chains")
    reach, most = 1, None
    while open_chains := chains.filter("up IS NOT NULL").count():
        most = open_chains + 1 if most is None else most
        if reach > most:
            break
        above = chains.select(
            "doc_id", F.col("node").alias("up"), F.col("up").alias("__up"), F.col("path").alias("__path"),
            (F.col("depth") + 1).alias("__depth"), *[F.col(f"__all_{name}").alias(f"__above_{name}") for name in sums],
        )
        joined = chains.filter("up IS NOT NULL").join(above, ["doc_id", "up"]).select(
            "doc_id", "node", "parent", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"),
            F.concat("__path", F.lit("."), "path").alias("path"), *[f"__own_{name}" for name in sums],
            *[(F.col(f"__all_{name}") + F.col(f"__above_{name}")).alias(f"__all_{name}") for name in sums],
        )
        chains = written(chains.filter("up IS NULL").unionByName(joined), "chains")
        reach *= 2
    found = [(F.col(f"__all_{name}") - F.col(f"__own_{name}")).alias(name) for name in sums]
    return chains.filter("up IS NULL").select("doc_id", "node", "parent", "depth", "path", *found)


def numbered(tree: DataFrame) -> DataFrame:
    """The nodes' places in pre-order, from 0."""
    return tree.withColumn("pos", F.row_number().over(W.partitionBy("doc_id").orderBy("path")) - 1)


def subtree(tree: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes at or below ``roots`` (doc_id, node), by prefixes of paths."""
    return _under(tree, roots, "left_semi")


def without_subtrees(tree: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes that are neither in ``roots`` nor below them."""
    return _under(tree, roots, "left_anti")


def _under(tree: DataFrame, roots: DataFrame, how: str) -> DataFrame:
    """Each node meets roots among its own ancestors' paths: an equi-join, not a range join."""
    tops = tree.join(roots.select("doc_id", "node"), ["doc_id", "node"], "left_semi").select("doc_id", F.col("path").alias("prefix"))
    steps = F.split("path", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "."))
    spread = tree.select("doc_id", "node", F.explode(prefixes).alias("prefix"))
    hit = spread.join(tops, ["doc_id", "prefix"], "left_semi").select("doc_id", "node").distinct()
    return tree.join(hit, ["doc_id", "node"], how)


def kept_with_new_parents(tree: DataFrame, keep: Column) -> DataFrame:
    """Nodes that meet ``keep``, each under its nearest kept ancestor (null: none)."""
    steps = F.split("path", r"\.")
    ahead = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "."))
    ancestors = F.when(F.size(steps) > 1, ahead).otherwise(F.array().cast("array<string>"))
    kept = tree.filter(keep)
    spread = kept.select("doc_id", "node", F.explode(ancestors).alias("prefix"))
    near = (
        spread.join(kept.select("doc_id", F.col("path").alias("prefix"), F.col("node").alias("ancestor"), "depth"), ["doc_id", "prefix"])
        .groupBy("doc_id", "node")
        .agg(F.max_by("ancestor", "depth").alias("new_parent"))
    )
    return kept.join(near, ["doc_id", "node"], "left")


def broken_links(edges: DataFrame) -> DataFrame:
    """Edges to parents that are no nodes of the document."""
    nodes = edges.select("doc_id", F.col("node").alias("parent"))
    return edges.filter("parent IS NOT NULL").join(nodes, ["doc_id", "parent"], "left_anti")


def inserted(siblings: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (doc_id, parent, after, node) put behind the siblings named, and all places renumbered."""
    old = siblings.select("doc_id", "parent", "node", F.col("ord").cast("double").alias("at"), F.lit(0).alias("fresh"))
    added = new.join(
        siblings.select("doc_id", "parent", F.col("node").alias("after"), "ord"), ["doc_id", "parent", "after"]
    ).select("doc_id", "parent", "node", (F.col("ord") + 0.5).alias("at"), F.lit(1).alias("fresh"))
    place = F.row_number().over(W.partitionBy("doc_id", "parent").orderBy("at", "fresh", "node")) - 1
    return old.unionByName(added).select("doc_id", "parent", "node", place.alias("ord"))


def concatenated(items: DataFrame, documents: DataFrame, into: str) -> DataFrame:
    """Items of ``documents`` (doc_id, ord, ``into``) as one document a group, pages shifted in order.

    items: doc_id, pos, page_no. Page numbers go on from the last document's greatest one.
    """
    spans = items.groupBy("doc_id").agg(F.max("page_no").alias("pages"), F.max("pos").alias("last"))
    before = W.partitionBy(into).orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    shifts = (
        documents.join(spans, "doc_id")
        .withColumn("page_shift", F.coalesce(F.sum("pages").over(before), F.lit(0)))
        .withColumn("pos_shift", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)))
        .select("doc_id", into, "page_shift", "pos_shift")
    )
    return items.join(shifts, "doc_id").select(
        into, (F.col("pos") + F.col("pos_shift")).alias("pos"), (F.col("page_no") + F.col("page_shift")).alias("page_no"),
        F.col("doc_id").alias("from_doc"),
    )


def page_breaks(items: DataFrame) -> DataFrame:
    """Items that begin a new page: after them comes no earlier page's item."""
    before = W.partitionBy("doc_id").orderBy("pos")
    return items.withColumn("breaks", F.coalesce(F.col("page_no") > F.lag("page_no").over(before), F.lit(False))).filter("breaks")


def value_targets(cells: DataFrame, links: DataFrame) -> DataFrame:
    """Each source cell with its targets' texts in order of their ids, comma-joined."""
    targets = links.join(cells.select(F.col("cell_id").alias("target"), "text"), "target")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("target", "text"))), lambda x: x["text"])
    return targets.groupBy("source").agg(F.array_join(listed, ", ").alias("targets"), F.count("*").alias("n"))


def dangling(cells: DataFrame, links: DataFrame) -> DataFrame:
    """Links with an end that is no cell."""
    ids = cells.select("cell_id")
    a = links.join(ids, links["source"] == ids["cell_id"], "left_anti")
    b = links.join(ids, links["target"] == ids["cell_id"], "left_anti")
    return a.unionByName(b).distinct()
