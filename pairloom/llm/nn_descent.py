"""Embedding near-dedup over a neighbour graph refined by NN-descent.

Vectors are compared within their label only. Equal vectors are one node from the start, so
copies are never paired. Each node starts with neighbours from a few orders of the nodes by
random hyperplanes (the nodes next to it). A round gathers, at every node, the vectors of
its neighbours and of the nodes that have it as a neighbour, compares them with one another
and offers each the best it meets; every node keeps the best `neighbours`, and more, up to
`most_neighbours`, as long as they are all over the threshold, that is while its list is
saturated. Rounds go on until one finds no new link.

Every link over the threshold that is met gives components, whether or not a list keeps it.
Nodes with full lists in different components of a label are compared with one another. Inside a component all nodes are compared once
more, in tiles of `TILE` by `TILE` nodes, which counts the links that a full list had no
room for, however large the component is, and puts out counts, never pairs. At the end the
links of `audited` of all nodes, and of half as many that have links, are compared with brute
force over all vectors. If a node lacks a link, orders by new hyperplanes are added and
rounds run again; labels that still fail after `most_audits` are compared whole, in tiles.

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component,
and vectors without a label, are their own component with no link. Vectors of different
lengths never link. Copies and rows that share an id count as one link each. A null id is in
its component but does not name it. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, lookup
from pairloom.llm.components import connected_components

TILE = 512
PLANES = 24


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    neighbours: int = 10
    most_neighbours: int = 20
    orders: int = 6
    window: int = 8
    audited: int = 300
    most_audits: int = 3
    seed: int = 7


def _unit(blobs, width: str):
    """Rows of unit length in double precision; all blobs have one length."""
    import numpy as np

    rows = np.frombuffer(b"".join(blobs), dtype=width).reshape(len(blobs), -1).astype(float)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(
        finite & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False)
    )


def _packed(width: str):
    import numpy as np
    import pyarrow as pa

    def batches(parts: Iterator) -> Iterator:
        for part in parts:
            vectors = [np.array(v.as_py(), dtype=width).tobytes() for v in part.column("vector")]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(vectors, pa.binary())],
                ["id", "label", "vector"],
            )

    return batches


def _coded(width: str, first: int, orders: int, seed: int):
    """A row per node and order, with the signs of its projections as a number."""
    import numpy as np
    import pandas as pd

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for size, rows in part.groupby(part["vector"].str.len(), sort=True):
                units = _unit(rows["vector"], width)
                for order in range(first, first + orders):
                    planes = np.random.default_rng([seed, order, int(size)])
                    signs = units @ planes.standard_normal((units.shape[1], PLANES)) > 0
                    code = signs @ (1 << np.arange(PLANES, dtype=np.int64))
                    yield rows.assign(order=order, code=code, size=int(size))

    return batches


def _windows(width: str, window: int, best: int):
    """Links of each row with the rows next to it in its order."""
    import numpy as np
    import pandas as pd

    def linked(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        units, node = _unit(rows["vector"], width), rows["node"].to_numpy()
        found = []
        for step in range(1, min(window, len(rows) - 1) + 1):
            sims = (units[:-step] * units[step:]).sum(axis=1)
            found.append((node[:-step], node[step:], sims))
            found.append((node[step:], node[:-step], sims))
        if found:
            u, v, sim = (np.concatenate(x) for x in zip(*found))
            links = pd.DataFrame({"u": u, "v": v, "sim": sim})
            yield links.sort_values("sim", ascending=False).groupby("u").head(best)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for part in parts:
            rows = part if tail is None else pd.concat([tail, part], ignore_index=True)
            for _, same in rows.groupby(["order", "label", "size"], sort=False):
                yield from linked(same)
            tail = rows.tail(window)

    return batches


def _local_joins(width: str, best: int):
    """What the members of each centre's neighbourhood offer one another."""
    import numpy as np
    import pandas as pd

    def offers(rows: pd.DataFrame) -> pd.DataFrame:
        centre, node = rows["centre"].to_numpy(), rows["node"].to_numpy()
        worst, units = rows["worst"].to_numpy(), _unit(rows["vector"], width)
        edges = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1], True])
        found = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if hi - lo < 2:
                continue
            sims = units[lo:hi] @ units[lo:hi].T
            np.fill_diagonal(sims, -2)
            top = min(best, hi - lo - 1)
            at = np.argpartition(-sims, top - 1, axis=1)[:, :top]
            sim = np.take_along_axis(sims, at, axis=1)
            row, column = np.nonzero(sim > worst[lo:hi, None])
            found.append((node[lo + row], node[lo + at[row, column]], sim[row, column]))
        u, v, sim = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [])
        links = pd.DataFrame({"u": u, "v": v, "sim": sim})
        return links.drop_duplicates(["u", "v"]).astype({"u": "int64", "v": "int64", "sim": float})

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows of the last centre may go on in the next batch
        for part in parts:
            rows = part if held is None else pd.concat([held, part], ignore_index=True)
            if len(rows):
                going_on = rows["centre"] == rows["centre"].iloc[-1]
                held = rows[going_on]
                # Lengths differ between labels only; a centre's rows have one.
                whole = rows[~going_on]
                for _, same in whole.groupby(whole["vector"].str.len()):
                    yield offers(same)
        if held is not None:
            yield offers(held)

    return batches


def _tile(width: str, threshold: float):
    import pandas as pd

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows["block"] == rows["tile_row"]]
        right = rows[rows["block"] == rows["tile_column"]]
        linked = _unit(left["vector"], width) @ _unit(right["vector"], width).T >= threshold
        same = left["node"].to_numpy()[:, None] == right["node"].to_numpy()
        linked &= ~same
        out = [pd.DataFrame({"node": left["node"], "links": linked @ right["n"].to_numpy()})]
        if rows["tile_row"].iloc[0] != rows["tile_column"].iloc[0]:
            turned = linked.T @ left["n"].to_numpy()
            out.append(pd.DataFrame({"node": right["node"], "links": turned}))
        return pd.concat(out)

    return counted


def _forest(width: str, threshold: float):
    """Links that connect what a tile's nodes over the threshold connect."""
    import numpy as np
    import pandas as pd

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        left = rows[rows["block"] == rows["tile_row"]].sort_values("node")
        right = rows[rows["block"] == rows["tile_column"]].sort_values("node")
        near = _unit(left["vector"], width) @ _unit(right["vector"], width).T >= threshold
        names = left["node"].to_numpy(), right["node"].to_numpy()
        nodes = np.unique(np.concatenate(names))
        rows_at, columns_at = (np.searchsorted(nodes, n) for n in names)
        group, found = np.arange(len(nodes)), []
        for i, at in enumerate(rows_at.tolist()):
            met = columns_at[near[i]]
            others, first = np.unique(group[met], return_index=True)
            new = others != group[at]
            found += [(nodes[at], nodes[j]) for j in met[first[new]].tolist()]
            group[np.isin(group, others[new])] = group[at]
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    return linked


class Graph:
    """Neighbour lists `(u, v, sim)` of the nodes, in a table per round."""

    def __init__(self, nodes: DataFrame, width: str, settings: Settings, scratch: Scratch):
        self.nodes, self.width, self.s, self.scratch = nodes, width, settings, scratch
        self.path = None
        self.lists = None
        self.met = None  # a forest of all links over the threshold, whatever lists drop

    def _meet(self, links: DataFrame) -> None:
        """Add links over the threshold to the forest."""
        if self.met is not None:
            links = links.unionByName(self.met)
        joined = connected_components(links, self.scratch)
        forest = joined.select(F.col("node").alias("u"), F.col("component").alias("v"))
        self.met = self.scratch.write(forest, "met")

    def across(self, nodes: DataFrame) -> None:
        """Compare all of these nodes that share a label and a length, in tiles."""
        sets = nodes.withColumn("set", F.concat_ws("/", F.length("vector"), "label"))
        counts = sets.groupBy("set").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        counts = self.scratch.write(counts, "counts")
        tiles = F.ceil(F.col("m") / TILE).cast("int")
        forest = (
            lookup(sets, counts, "set", "m")
            .withColumn("block", F.pmod(F.xxhash64("node"), tiles).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .withColumn("tile_row", F.least("block", "other"))
            .withColumn("tile_column", F.greatest("block", "other"))
            .groupBy("set", "tile_row", "tile_column")
            .applyInPandas(_forest(self.width, self.s.threshold), "u long, v long")
        )
        self._meet(forest)

    def bridge(self) -> None:
        """Find links between full lists. Only two nodes whose lists are both saturated can
        have dropped their link; those of different components are compared."""
        full = (
            self.lists.filter(F.col("sim") >= self.s.threshold)
            .groupBy("u")
            .agg(F.count(F.lit(1)).alias("held"))
            .filter(F.col("held") >= self.s.most_neighbours)
            .select(F.col("u").alias("node"))
        )
        placed = self.met.select(F.col("u").alias("node"), F.col("v").alias("component"))
        held = full.join(placed, "node").join(self.nodes.select("node", "label", "vector"), "node")
        held = self.scratch.write(held, "full")
        several = held.groupBy("label").agg(
            (F.min("component") < F.max("component")).alias("several"), F.count("*").alias("n")
        )
        several = self.scratch.write(several.filter("several").select("label", "n"), "several")
        if not several.isEmpty():
            self.across(lookup(held, several, "label", "n").select("node", "label", "vector"))

    def _keep(self, offered: DataFrame) -> None:
        """Merge new links into the lists and cut each to its length."""
        offered = self.scratch.write(offered, "offered")
        self._meet(offered.filter(F.col("sim") >= self.s.threshold).select("u", "v"))
        both = offered if self.lists is None else self.lists.unionByName(offered)
        rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
        full = (F.col("rank") <= self.s.neighbours) | (
            (F.col("sim") >= self.s.threshold) & (F.col("rank") <= self.s.most_neighbours)
        )
        lists = (
            both.repartition("u")
            .groupBy("u", "v")
            .agg(F.max("sim").alias("sim"))
            .withColumn("rank", rank)
            .filter(full)
        )
        path, last = self.scratch.path("lists"), self.path
        lists.write.option("compression", "lz4").parquet(path)
        schema = "u long, v long, sim double, rank int"
        self.lists = lists.sparkSession.read.schema(schema).parquet(path).drop("rank")
        self.path = path
        if last:
            self.scratch.drop(last)

    def seed(self, first: int) -> None:
        orders = self.nodes.select("node", "label", "vector").mapInPandas(
            _coded(self.width, first, self.s.orders, self.s.seed),
            "node long, label string, vector binary, order int, code long, size int",
        )
        keys = ("order", "label", "size", "code", "node")
        self._keep(
            orders.repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .mapInPandas(
                _windows(self.width, self.s.window, self.s.neighbours // 2),
                "u long, v long, sim double",
            )
        )

    def links(self) -> tuple:
        """Tells whether a round has found a link: lists only ever get better."""
        over = self.lists.filter(F.col("sim") >= self.s.threshold)
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        return (*over.agg(F.count(F.lit(1)), checksum).first(), self.met.count())

    def refine(self) -> None:
        """One round of neighbours of neighbours."""
        worst = self.lists.groupBy("u").agg(
            F.count(F.lit(1)).alias("m"), F.min("sim").alias("worst")
        )
        # A list that is not full takes anything, a saturated one any further link.
        bar = F.when(F.col("m") < self.s.neighbours, -1.0).otherwise(
            F.least("worst", F.lit(self.s.threshold - 1e-9))
        )
        known = self.nodes.select("node", "vector").join(
            worst.select(F.col("u").alias("node"), bar.alias("worst")), "node"
        )
        pair = lambda c, n: self.lists.select(
            F.col(c).alias("centre"), F.col(n).alias("node"), "sim"
        )
        rank = F.row_number().over(Window.partitionBy("centre").orderBy(F.desc("sim"), "node"))
        nearest = (
            pair("u", "v")
            .unionByName(pair("v", "u"))
            .repartition("centre")
            .distinct()
            .withColumn("rank", rank)
            .filter(F.col("rank") <= 2 * self.s.neighbours)
            .select("centre", "node")
        )
        self._keep(
            nearest.join(known, "node")
            .repartition("centre")
            .sortWithinPartitions("centre")
            .mapInPandas(
                _local_joins(self.width, self.s.neighbours), "u long, v long, sim double"
            )
        )

    def settle(self) -> None:
        before = self.links()
        while True:
            self.refine()
            now = self.links()
            if now == before:
                return
            before = now

    def linked(self) -> DataFrame:
        """`(node, component, links)` of every node, with links counted exactly inside
        the components."""
        self.bridge()
        joined = self.met.select(F.col("u").alias("node"), F.col("v").alias("component"))
        sizes = self.scratch.write(
            joined.groupBy("component").agg(F.count(F.lit(1)).alias("m")), "sizes"
        )
        tiles = F.ceil(F.col("m") / TILE).cast("int")
        members = (
            lookup(joined, sizes, "component", "m")
            .join(self.nodes.select("node", "vector", "n"), "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), tiles).cast("int"))
        )
        counts = (
            members.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .withColumn("tile_row", F.least("block", "other"))
            .withColumn("tile_column", F.greatest("block", "other"))
            .groupBy("component", "tile_row", "tile_column")
            .applyInPandas(_tile(self.width, self.s.threshold), "node long, links long")
            .groupBy("node")
            .agg(F.sum("links").alias("links"))
        )
        return self.scratch.write(joined.join(counts, "node"), "linked")


def brute_force_links(
    nodes: DataFrame, queries: list, width: str, threshold: float
) -> dict[int, int]:
    """Links of each query `(node, label, vector)`, against all nodes."""
    import numpy as np
    import pandas as pd

    sets: dict[tuple, list] = {}
    for q in queries:
        sets.setdefault((q.label, len(q.vector)), []).append(q)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for key, rows in part.groupby([part["label"], part["vector"].str.len()]):
                if asked := sets.get(key):
                    near = _unit([bytes(q.vector) for q in asked], width) @ _unit(
                        rows["vector"], width
                    ).T
                    ids = np.array([q.node for q in asked])
                    near = (near >= threshold) & (ids[:, None] != rows["node"].to_numpy())
                    yield pd.DataFrame({"node": ids, "links": near @ rows["n"].to_numpy()})

    found = (
        nodes.select("node", "label", "vector", "n")
        .mapInPandas(batches, "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    return {r.node: r.links for r in found.collect()}


def audit(nodes: DataFrame, linked: DataFrame, width: str, settings: Settings) -> list[str]:
    """Labels of which a sampled node lacks a true link; each node counts alike.

    `audited` of all nodes are sampled, and half as many of those with links, which are rare.
    """
    sample = lambda df, n: [
        r.node for r in df.orderBy(F.xxhash64("node"), "node").select("node").limit(n).collect()
    ]
    chosen = {*sample(nodes, settings.audited), *sample(linked, settings.audited // 2)}
    queries = nodes.filter(F.col("node").isin(list(chosen))).collect() if chosen else []
    if not queries:
        return []
    true = brute_force_links(nodes, queries, width, settings.threshold)
    found = {r.node: r.links for r in linked.filter(F.col("node").isin(list(chosen))).collect()}
    return sorted({q.label for q in queries if found.get(q.node, 0) < true.get(q.node, 0)})


def near_vectors(
    vectors: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: `(vec_id, n_links, component_id, kept)`."""
    scratch = Scratch(vectors.sparkSession, "neighbours")
    single = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    width, kind = ("<f4", "float") if single else ("<f8", "double")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast(f"array<{kind}>").alias("vector"),
    )
    usable = F.col("label").isNotNull() & _valid(F.col("vector"))
    packed = rows.filter(usable).mapInArrow(
        _packed(width), "id long, label string, vector binary"
    )
    keyed = scratch.write(
        packed.withColumn(
            "digest", F.sha2(F.concat(F.encode("label", "UTF-8"), F.lit(b"\x00"), "vector"), 256)
        ),
        "vectors",
    )
    groups = keyed.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("least"),
        F.first("label").alias("label"),
        F.first("vector").alias("vector"),
    )
    nodes = scratch.write(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")

    graph = Graph(nodes, width, settings, scratch)
    for turn in range(settings.most_audits):
        graph.seed(turn * settings.orders)
        graph.settle()
        linked = graph.linked()
        if not (failing := audit(nodes, linked, width, settings)):
            break
    else:
        graph.across(nodes.filter(F.col("label").isin(failing)).select("node", "label", "vector"))
        linked = graph.linked()
    placed = nodes.select("digest", "node", "n", "least").join(linked, "node", "left")
    placed = scratch.write(
        placed.select(
            "digest",
            "n",
            "least",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        "placed",
    )
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("digest", "n", "n_links", "component_id")
    alone = rows.filter(~usable).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return (
        lookup(keyed.select("id", "digest"), named, "digest", "n")
        .select("id", "n_links", "component_id")
        .unionByName(alone)
        .select(
            F.col("id").alias(id_col),
            "n_links",
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
