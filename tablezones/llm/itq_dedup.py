"""Embedding near-dedup by iterative quantisation.

Vectors are centred, turned to their principal axes and then by a learned
rotation that brings them close to the corners of a cube, so that signs make
balanced binary codes. Two such codes (rotations from different starts) of 64
bits are cut into substrings of ``WIDTH`` bits, one hash table each. A query
probes each table with its own substring and with those one bit away, so a pair
is retrieved when some substring differs in at most one bit; each pair is
emitted at the first such table only. Retrieved pairs within ``RADIUS`` bits
are reranked by the cosine of the original vectors in double precision.

The rotations are fitted on at most ``SAMPLE`` vectors in hash order; every
vector is indexed and queried. For larger tables ``width`` should grow with the
logarithm of a label's vectors, so that a bucket stays small.

Equal vectors of a label form a class first; classes are compared, not copies,
and a class's size counts in its links. Only vectors of equal label and length
are compared. A vector that is null, empty, zero or holds null or non-finite
components, or whose label or vec_id is null, links with nothing. Rows of one
vec_id are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.components import components
from tablezones.llm.staging import staged

COSINE, SAMPLE, ROTATIONS, BITS, WIDTH, RADIUS, STEPS = 0.93, 5_000, 2, 64, 16, 24, 50
CODES = "rep long, label long, size long, embedding array<double>, dim int, " + ", ".join(f"c{k} long" for k in range(ROTATIONS))


def _units(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as unit rows, and their places; called for each length in turn."""
    vectors = batch.column(column)
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield rows, flat[(ends[rows] - dim)[:, None] + np.arange(dim)]


def fit_rotation(x: np.ndarray, seed: int, bits: int = BITS, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection whose signs are the code of a unit vector."""
    rng = np.random.default_rng(seed)
    bits = min(bits, x.shape[1])
    centre = x.mean(0) if len(x) else np.zeros(x.shape[1])
    axes = np.eye(x.shape[1])[:, :bits]
    if len(x) > bits:
        axes = np.linalg.eigh(np.cov((x - centre).T).reshape(x.shape[1], x.shape[1]))[1][:, ::-1][:, :bits]
    z = (x - centre) @ axes
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(steps if len(x) > bits else 0):
        corner = np.where(z @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(corner.T @ z)
        turn = (u @ v).T
    return centre, axes @ turn


def binary_codes(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    signs = ((x - model[0]) @ model[1]) >= 0
    packed = np.zeros((len(x), BITS), bool)
    packed[:, : signs.shape[1]] = signs
    return np.packbits(packed, axis=1, bitorder="little").view("<i8")[:, 0]


def _coded(models: dict):
    def code(batches):
        for batch in batches:
            dims = np.zeros(len(batch), np.int32)
            codes = np.zeros((ROTATIONS, len(batch)), np.int64)
            for rows, x in _units(batch, "embedding"):
                x = x / np.linalg.norm(x, axis=1)[:, None]
                dim = x.shape[1]
                dims[rows] = dim
                for k in range(ROTATIONS):
                    # a length that the sample lacks gets an unlearned rotation
                    codes[k, rows] = binary_codes(x, models[dim][k] if dim in models else fit_rotation(np.zeros((0, dim)), k))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), *map(pa.array, codes)], [*batch.schema.names, "dim", *[f"c{k}" for k in range(ROTATIONS)]])

    return code


def _reranked(least: float):
    def rerank(batches):
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for (rows, x), (_, y) in zip(_units(batch, "va"), _units(batch, "vb")):
                keep[rows] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return rerank


def similar_vectors(embeddings: DataFrame, least: float = COSINE, width: int = WIDTH) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding, label)."""
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd & F.exists("embedding", lambda x: x != 0)
    classes = every.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    classes = staged(classes.select("rep", "label", "size", "embedding"), "vector-classes")

    sample = classes.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row["embedding"]), []).append(row["embedding"])
    units = {d: np.array(v) / np.linalg.norm(np.array(v), axis=1)[:, None] for d, v in by_dim.items()}
    models = {d: [fit_rotation(x, seed) for seed in range(ROTATIONS)] for d, x in units.items()}
    coded = staged(classes.mapInArrow(_coded(models), CODES), "codes")

    names = ["rep", "label", "dim", *[f"c{k}" for k in range(ROTATIONS)]]
    tables = [(k, at) for k in range(ROTATIONS) for at in range(0, BITS, width)]
    mask = (1 << width) - 1
    part = lambda c, at: F.shiftrightunsigned(c, at).bitwiseAND(F.lit(mask))
    keys = F.posexplode(F.array(*[part(F.col(f"c{k}"), at) for k, at in tables])).alias("t", "key")
    index = coded.select(*[F.col(n).alias(f"{n}_a") for n in names], keys).withColumnsRenamed({"t": "t_a", "key": "key_a"})
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(width)]).cast("array<long>")
    query = coded.select(*[F.col(n).alias(f"{n}_b") for n in names], keys).withColumn("flip", F.explode(flips)).select("*", F.col("key").bitwiseXOR(F.col("flip")).alias("key_b"))
    apart = [F.col(f"c{k}_a").bitwiseXOR(F.col(f"c{k}_b")) for k in range(ROTATIONS)]
    first = F.coalesce(*[F.when(F.bit_count(part(apart[k], at)) <= 1, F.lit(t)) for t, (k, at) in enumerate(tables)])
    near = (first == F.col("t")) & (F.col("rep_a") < F.col("rep_b"))
    for x in apart:
        near = near & (F.bit_count(x) <= RADIUS)
    same = (F.col("label_a") == F.col("label_b")) & (F.col("dim_a") == F.col("dim_b")) & (F.col("t_a") == F.col("t")) & (F.col("key_a") == F.col("key_b"))
    pairs = index.join(query, same & near).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    vector = lambda c: coded.select(F.col("rep").alias(c), F.col("embedding").alias(f"v{c}"))
    links = staged(pairs.join(vector("a"), "a").join(vector("b"), "b").mapInArrow(_reranked(least), "a long, b long"), "vector-links")

    sizes = coded.select("rep", "size")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes, both["b"] == sizes["rep"]).groupBy("a").agg(F.sum("size").alias("others"))
    comps = components(links)
    known = coded.select("rep", "label", "embedding", "size").join(linked, coded["rep"] == linked["a"], "left").join(comps, coded["rep"] == comps["node"], "left")
    known = staged(known.select("label", "embedding", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "vector-components")
    out = every.withColumn("ok", F.coalesce(usable, F.lit(False)))
    joined = out.where("ok").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = out.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionAll(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
