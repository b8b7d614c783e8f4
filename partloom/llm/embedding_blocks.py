"""Embedding near-duplicates: a pigeonhole join over blocks of rotated vectors.

Unit vectors with cosine of at least ``similarity`` are at a squared distance of at most
``2 - 2 * similarity``. Rotated (which keeps distances and evens the coordinates out) and cut into
blocks, at least one block of such a pair is within the share of that budget that its dimensions have. So
each block is range-joined on its own: a grid over some coordinates deals vectors to cells, each
vector also to the lower neighbour cells that its ball reaches, and cells compare their vectors within
the block's budget. Candidates are verified by the exact cosine of the original vectors, in double
precision, and a linked pair is counted in the first block that finds it, so the union needs no
distinct step and no pairs leave a task.

Equal vectors are one row until the end. The number of gridded coordinates follows the number of
vectors. A cell with many rows is cut into blocks and every pair of blocks is a group, so groups are
bounded. Block distances are sums of whole numbers, hence the same wherever a pair is looked at.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing (not even with equal ones); vectors of different length do not link; rows that repeat a vec_id
are taken once, rows without one are left out; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partloom.llm.common import components, merge_pairs, plain, stored, work_folder

#: Dimensions of a block.
BLOCK_DIMS = 8
#: Vectors that a cell should hold, and rows of one side of a group. Every gridded coordinate doubles the
#: copies that are sent, so cells are as large as a group has room for.
CELL, SIDE = 16_384, 65_536
#: Rotated coordinates are kept as whole numbers of this many steps.
_STEPS = 1 << 13
_TILE = 1024


def blocks_of(dims: int) -> list[slice]:
    count = max(1, round(dims / BLOCK_DIMS))
    edges = [round(i * dims / count) for i in range(count + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def budgets(dims: int, similarity: float) -> np.ndarray:
    """Squared distance that each block may have, in squared steps; rounding of the coordinates included."""
    out = []
    for block in blocks_of(dims):
        share = (block.stop - block.start) / dims
        radius = math.sqrt(max(0.0, 2 - 2 * similarity) * share) + 1e-9
        out.append((radius * _STEPS + math.sqrt(block.stop - block.start)) ** 2 + 1)
    return np.array(out)


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def rotated(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors, turned and rounded to whole steps."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.rint(unit @ turn * _STEPS).astype(np.int16)


def _kind(vectors: DataFrame) -> type:
    """Floats are sent as floats; all else as doubles. Both are compared as doubles."""
    return np.float32 if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else np.float64


def _packed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``vec`` (its components as bytes; null where the vector links with nothing) and its ``dims``."""
    kind = _kind(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = plain(batch.column("embedding"))
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # null components become NaN
            size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
            size = np.where(lists.is_valid().to_numpy(zero_copy_only=False), size, 0)
            ends = np.cumsum(size)
            out = []
            for end, n in zip(ends, size, strict=True):
                v = flat[end - n: end].astype(kind)
                top = np.abs(v).max() if n else 0.0
                out.append(v.tobytes() if n and np.isfinite(v).all() and top > 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(out, pa.binary()), pa.array(size, pa.int32())], names=["vec_id", "vec", "dims"]
            )

    slim = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if kind is np.float32 else "array<double>"))
    return slim.mapInArrow(run, "vec_id long, vec binary, dims int")


def cells(turned: np.ndarray, similarity: float, coordinates: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: (block, rows, cell keys, whether the cell is the row's home). A row goes to its home
    cell and to lower cells within reach; cells are as wide as the reach, so those are neighbours."""
    dims = turned.shape[1]
    for number, (block, budget) in enumerate(zip(blocks_of(dims), budgets(dims, similarity), strict=True)):
        used = min(coordinates, block.stop - block.start)
        part = turned[:, block][:, :used].astype(np.float64) / math.sqrt(budget)
        home = np.floor(part).astype(np.int64)
        rows = np.arange(len(turned))
        for step in product((-1, 0, 1), repeat=used):
            if step > (0,) * used:
                continue
            shift = np.array(step, dtype=np.int64).reshape(1, used)
            gap = np.where(shift < 0, part - home, np.where(shift > 0, home + 1 - part, 0.0))
            near = (gap**2).sum(axis=1) <= 1.0 + 1e-9
            cell = home[near] + shift
            key = np.zeros(len(cell), np.int64)
            for column in cell.T:
                key = key * 64 + (column & 63)  # cells that share a key are far apart, so nothing more is linked
            yield number, rows[near], key, np.full(len(cell), not any(step))


def _sides(turned: np.ndarray, block: slice) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose products are half the negated squared distances of the block's parts, for either side."""
    part = turned[:, block].astype(np.float32) / _STEPS
    half, one = -(part**2).sum(axis=1, keepdims=True) / 2, np.ones((len(part), 1), np.float32)
    return np.hstack([part, half, one]), np.hstack([part, one, half])


def _found_pairs(a: np.ndarray, b: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that may be within the budget: single precision, with room for its error."""
    within = a @ b.T >= -(budget / _STEPS**2) / 2 - 1e-5
    flat = np.flatnonzero(within)
    return flat // within.shape[1], flat % within.shape[1]


def linked_in_cell(number: int, home: pd.DataFrame, other: pd.DataFrame, similarity: float, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (home row, other row) that are linked and that no block before ``number`` finds."""
    h, o = (np.frombuffer(b"".join(f["vec"]), kind).reshape(len(f), -1) for f in (home, other))
    th, to = (np.frombuffer(b"".join(f["turned"]), np.int16).reshape(len(f), -1) for f in (home, other))
    dims = th.shape[1]
    parts, allowed = blocks_of(dims), budgets(dims, similarity)
    nh, no = (np.sqrt(np.einsum("ij,ij->i", v, v, dtype=np.float64)) for v in (h, o))
    ids_h, ids_o = home["rep"].to_numpy(), other["rep"].to_numpy()
    at_home = other["home"].to_numpy(bool)
    sides = _sides(th, parts[number])[0], _sides(to, parts[number])[1]
    for i in range(0, len(h), _TILE):
        for j in range(0, len(o), _TILE):
            x, y = _found_pairs(sides[0][i: i + _TILE], sides[1][j: j + _TILE], allowed[number])
            x, y = x + i, y + j
            # Two rows at home in this cell are one pair; a visitor's home is another cell.
            once = ~at_home[y] | (ids_o[y] < ids_h[x])
            x, y = x[once], y[once]
            for at in range(0, len(x), 65_536):
                p, q = x[at: at + 65_536], y[at: at + 65_536]
                near = np.einsum("ij,ij->i", h[p], o[q], dtype=np.float64) / (nh[p] * no[q]) >= similarity
                p, q = p[near], q[near]
                if len(p):
                    # Whole numbers from here on: this block, and none before it, has the pair.
                    apart = (th[p].astype(np.int64) - to[q]) ** 2
                    inside = [apart[:, parts[k]].sum(axis=1) <= allowed[k] for k in range(number + 1)]
                    mine = inside[number] & ~np.any(inside[:number], axis=0) if number else inside[0]
                    p, q = p[mine], q[mine]
                if len(p):
                    yield p, q


def near_duplicates(vectors: DataFrame, similarity: float = 0.9, seed: int = 5, folder: str | None = None) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector of ``vectors`` (vec_id, embedding)."""
    folder = folder or work_folder(vectors.sparkSession)
    whole = _packed(vectors).groupBy("vec_id").agg(F.max(F.struct("vec", "dims")).alias("v")).select("vec_id", "v.*")
    packed, kind = stored(whole, folder, "packed"), _kind(vectors)
    usable = packed.where("vec IS NOT NULL")
    reps = usable.groupBy("vec", "dims").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for vec, dims in zip(batch.column("vec").to_pylist(), batch.column("dims").to_pylist(), strict=True):
                if dims not in turns:
                    turns[dims] = rotation(dims, seed)
                out.append(rotated(np.frombuffer(vec, kind)[None, :].astype(np.float64), turns[dims])[0].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "turned"])

    reps = stored(reps.mapInArrow(turn, "vec binary, dims int, rep long, copies long, turned binary"), folder, "reps")
    n = reps.count()
    # About five cells a coordinate are inhabited.
    coordinates = min(BLOCK_DIMS, max(1, round(math.log(max(1.0, n / CELL)) / math.log(5))))

    def placed(with_vectors: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims):
                    same = batch.filter(pa.array(dims == d))
                    turned = np.stack([np.frombuffer(v, np.int16) for v in same.column("turned").to_pylist()])
                    for number, rows, key, home in cells(turned, similarity, coordinates):
                        if not len(rows):
                            continue
                        same_dims, same_block = (pa.array(np.full(len(rows), x, np.int32)) for x in (d, number))
                        out = [same_dims, same_block, pa.array(key), pa.array(home)]
                        names = ["dims", "block", "cell", "home"]
                        if with_vectors:
                            out += [same.column(c).take(pa.array(rows)) for c in ("rep", "copies", "vec", "turned")]
                            names += ["rep", "copies", "vec", "turned"]
                        yield pa.RecordBatch.from_arrays(out, names=names)

        return run

    slim = reps.select("dims", "turned").mapInArrow(placed(False), "dims int, block int, cell long, home boolean")
    counts = slim.groupBy("dims", "block", "cell").agg(F.count_if("home").alias("homes"), F.count("*").alias("rows"))
    # Cells without a row at home, or with a single row, compare nothing.
    sizes = stored(counts.where("homes > 0 AND rows > 1").select(
        "dims", "block", "cell", F.ceil(F.col("homes") / SIDE).cast("int").alias("home_parts"), F.ceil(F.col("rows") / SIDE).cast("int").alias("parts")
    ), folder, "cells")
    dealt = reps.mapInArrow(placed(True), "dims int, block int, cell long, home boolean, rep long, copies long, vec binary, turned binary")
    dealt = dealt.join(sizes, ["dims", "block", "cell"])
    as_home = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.pmod(F.xxhash64("rep"), F.col("home_parts")).cast("int").alias("i"), j.alias("j"), F.lit(True).alias("is_home")))
    as_other = F.transform(F.sequence(F.lit(0), F.col("home_parts") - 1), lambda i: F.struct(
        i.alias("i"), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("parts")).cast("int").alias("j"), F.lit(False).alias("is_home")))
    # In a cell of one group a home row is sent once and stands on both sides.
    one = (F.col("home_parts") == 1) & (F.col("parts") == 1)
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home").alias("is_home")))
    seats = F.when(one, single).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    groups = dealt.select("dims", "block", "cell", "home", "rep", "copies", "vec", "turned", one.alias("one"), F.explode(seats).alias("seat"))
    groups = groups.select("dims", "block", "cell", "home", "rep", "copies", "vec", "turned", "one", "seat.i", "seat.j", "seat.is_home")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        number, one = int(key[1]), bool(frame["one"].iloc[0])
        home = frame[frame["is_home"]]
        other = frame if one else frame[~frame["is_home"]]
        ids = frame["rep"].unique()
        empty = pd.DataFrame({"rep": np.empty(0, np.int64), "links": np.empty(0, np.int64), "fellow": np.empty(0, np.int64)})
        if not len(home) or not len(other):
            return empty
        place = pd.Index(ids)
        ph, po = place.get_indexer(home["rep"]), place.get_indexer(other["rep"])
        wh, wo = home["copies"].to_numpy(), other["copies"].to_numpy()
        links = np.zeros(len(ids), np.int64)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for p, q in linked_in_cell(number, home, other, similarity, kind):
            np.add.at(links, ph[p], wo[q])
            np.add.at(links, po[q], wh[p])
            a, b = merge_pairs(np.concatenate([a, ids[ph[p]]]), np.concatenate([b, ids[po[q]]]))
        fellow = np.array(ids, np.int64)
        fellow[place.get_indexer(a)] = b
        met = links > 0
        return pd.DataFrame({"rep": ids[met], "links": links[met], "fellow": fellow[met]})

    met = stored(groups.groupBy("dims", "block", "cell", "i", "j").applyInPandas(compare, "rep long, links long, fellow long"), folder, "met")
    joined = components(met.select(F.col("rep").alias("a"), F.col("fellow").alias("b")), folder)
    linked = met.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.select("vec", "dims", "rep", "copies").join(linked, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    classes = classes.select(
        "vec", "dims", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    return packed.join(classes, ["vec", "dims"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
