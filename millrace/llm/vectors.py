"""Near-duplicate vectors by graphs per shard, audited and verified."""

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.graphs import Graph, audited_beam
from millrace.llm.shared import components, map_batches, written

#: Different vectors in a shard, about; first beam; audited vectors of a shard; share
#: of their near pairs that a beam must find; slack of single precision.
SHARD, BEAM, AUDIT, RECALL, SLACK = 8192, 64, 256, 0.995, 1e-4
#: Queries whose exact cosines are computed together.
EXACT = 1024
BLOCK = "label int, dims int, shard int, block binary"


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that no square overflows or vanishes
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _build(least: float):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class_id", ignore_index=True)
        units = _unit(np.stack(rows["embedding"].to_numpy()).astype(np.float64))
        graph = Graph.build(units.astype(np.float32))
        beam = audited_beam(graph, least - SLACK, BEAM, AUDIT, RECALL)
        block = {
            "ids": rows["class_id"].to_numpy(np.int64),
            "sizes": rows["size"].to_numpy(np.int64),
            "units": units,
            "graph": graph.to_bytes(),
            "beam": beam,
        }
        place = rows[["label", "dims", "shard"]].head(1)
        return place.assign(block=[pickle.dumps(block, protocol=5)])

    return build


def _near(graph: Graph, queries: np.ndarray, least: float, beam: int):
    """Rows and columns that may be near. Beam 0, an unreachable node: all are looked at."""
    if beam:
        for rows, ids, _ in graph.above(queries.astype(np.float32), least - SLACK, beam):
            yield rows, ids
        return
    for start in range(0, len(queries), EXACT):
        near = queries[start : start + EXACT].astype(np.float32) @ graph.vectors.T >= least - SLACK
        rows, ids = np.nonzero(near)
        yield rows + start, ids


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links that join what the matrix ``near`` joins; fewer than there are vectors."""
    shift = 0 if same else len(left)
    joined = np.arange(len(left) if same else len(left) + len(right))
    links = []
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        others = np.flatnonzero(near[i])
        tops, first = np.unique(joined[others + shift], return_index=True)
        for top, j in zip(tops.tolist(), others[first].tolist(), strict=True):
            own = joined[i]
            if top != own:
                joined[joined == max(own, top)] = min(own, top)
                links.append((int(left[i]), int(right[j])))
    return links


def _linked_sizes(near: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of ``sizes`` over the true columns of each row."""
    return np.array([int(sizes[row].sum()) for row in near], np.int64)


def _compare(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ours, theirs in zip(batch["ours"], batch["theirs"], strict=True):
                a = pickle.loads(ours.as_py())
                same = not theirs.is_valid
                b = a if same else pickle.loads(theirs.as_py())
                near = np.zeros((len(a["ids"]), len(b["ids"])), bool)
                for rows, ids in _near(Graph.from_bytes(b["graph"]), a["units"], least, b["beam"]):
                    for part in range(0, len(rows), 65_536):
                        i, j = rows[part : part + 65_536], ids[part : part + 65_536]
                        exact = np.einsum("ij,ij->i", a["units"][i], b["units"][j]) >= least
                        near[i[exact], j[exact]] = True
                if same:
                    near |= near.T
                    np.fill_diagonal(near, False)
                counts = [(a["ids"], _linked_sizes(near, b["sizes"]))]
                if not same:
                    counts.append((b["ids"], _linked_sizes(near.T, a["sizes"])))
                links = _forest(near, a["ids"], b["ids"], same)
                u = np.concatenate([ids[n > 0] for ids, n in counts])
                n = np.concatenate([n[n > 0] for _, n in counts])
                for start in range(0, len(u), 10_000):
                    part = slice(start, start + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(u[part]), pa.nulls(len(u[part]), pa.int64()), pa.array(n[part].astype(np.int64))], names=["u", "v", "n"])
                if links:
                    u, v = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.nulls(len(u), pa.int64())], names=["u", "v", "n"])

    return compare


def near_vectors(embeddings: DataFrame, cosine: float = 0.93) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each vector.

    Vectors of one label, not null, and one length link at a cosine, in double
    precision, of ``cosine`` or more. ``n_links`` counts the other vectors linked
    directly; ``component_id`` is the smallest id that links reach; ``kept`` marks
    it. A vector that is null, empty, zero, or has null or non-finite components has
    no link, nor has one whose label or id is null; a null id has a null component
    and is not kept. Equal vectors of one label are one class, compared once and
    counted in full. Repeated rows are vectors of their own. Other columns are
    ignored; an empty table gives an empty result.

    The classes of a label are cut into shards by a hash. Each shard gets a graph,
    whose beam is widened until an audit against brute force passes; every shard is
    searched with every vector of its label, a pair of shards at a time, so a task
    holds two shards however large a label is.
    """
    usable = (
        "label is not null and vec_id is not null and size(embedding) > 0 and "
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and "
        "exists(embedding, x -> x <> 0)"
    )
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("usable", F.coalesce(F.expr(usable), F.lit(False)))
    key = F.when(F.col("usable"), F.struct(F.col("label").cast("int").alias("label"), F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding")))
    rows = rows.select("vec_id", key.alias("key"))
    classes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("size"))
    # one id may stand for several vectors, so a class is named by its vector as well
    classes = written(classes.select("class_id", "size", "key.*"), "vector-classes")
    classes = classes.withColumn("dims", F.size("embedding")).withColumn("name", F.xxhash64("label", "embedding"))
    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    placed = classes.join(sizes, ["label", "dims"]).withColumn("shard", F.expr("pmod(xxhash64(name, 3), shards)").cast("int"))
    placed = placed.select("label", "dims", "shard", F.col("name").alias("class_id"), "size", "embedding")
    blocks = written(placed.groupBy("label", "dims", "shard").applyInPandas(_build(cosine), BLOCK), "vector-graphs")
    places = blocks.select("label", "dims", "shard")
    pairs = places.withColumnRenamed("shard", "first").join(places.withColumnRenamed("shard", "second"), ["label", "dims"]).where("first <= second")
    ours = blocks.select("label", "dims", F.col("shard").alias("first"), F.col("block").alias("ours"))
    theirs = blocks.select("label", "dims", F.col("shard").alias("second"), F.col("block").alias("theirs"))
    pairs = pairs.join(ours, ["label", "dims", "first"])
    other = F.col("first") == F.col("second")
    pairs = pairs.join(theirs, ["label", "dims", "second"]).withColumn("theirs", F.when(~other, F.col("theirs")))
    pairs = pairs.repartition("label", "dims", "first", "second").select("ours", "theirs")
    found = written(map_batches(pairs, _compare(cosine), "u long, v long, n long"), "vector-links", batch_rows=1)

    counts = found.where("n is not null").groupBy("u").agg(F.sum("n").alias("others"))
    roots = components(found.where("n is null").select("u", "v"))
    named = classes.join(counts.withColumnRenamed("u", "name"), "name", "left").join(roots.withColumnRenamed("node", "name"), "name", "left")
    named = written(named.select("label", "embedding", "class_id", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "name").alias("root")), "vector-classes")
    least = named.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "root").select(F.struct("label", "embedding").alias("key"), "n_links", "component_id")
    joined = rows.join(named, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
