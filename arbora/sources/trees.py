"""Tree inputs: Newick files, edge tables, topology manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arbora.operators import trees as T


def read_newick(spark: SparkSession, path: str) -> list[T.Node]:
    """The trees of a text file, one a line or one over several lines; more than MOST_NODES lines raise."""
    lines = spark.read.text(path).limit(T.MOST_NODES + 1).collect()
    if len(lines) > T.MOST_NODES:
        raise T.TreeError("too many lines for trees")
    text = "\n".join(r["value"] for r in lines)
    return [T.parse_newick(part + ";") for part in text.split(";") if part.strip()]


def from_edge_table(edges: DataFrame, topology: str = "topology", parent: str = "parent", child: str = "child") -> list[tuple[str, T.Node]]:
    """The trees of an edge table, which is metadata: at most MOST_NODES rows are accepted."""
    rows = edges.select(topology, parent, child).limit(T.MOST_NODES + 1).collect()
    if len(rows) > T.MOST_NODES:
        raise T.TreeError("too many edges for trees")
    by: dict[str, list[tuple[str, str]]] = {}
    for t, p, c in rows:
        by.setdefault(t, []).append((p, c))
    return [(t, T.from_edges(sorted(e))) for t, e in sorted(by.items())]
