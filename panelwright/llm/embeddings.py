"""Near-duplicate vectors: a pigeonhole join over low-dimensional blocks of the rotated vectors, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import components, settle

#: Vectors of one side that a task compares, and how many at a time.
SIDE_ROWS, TILE_ROWS = 16384, 1024
#: Coordinates of a block that the grid of its range join uses.
GRID_DIMS = 2
#: Allowances for rounding in the distances that propose pairs, in double and in single precision; links are decided by
#: the cosine itself.
SLACK, SINGLE_SLACK = 1e-9, 1e-5
#: Share of a tile's pairs from which on all of them are verified by matrix products.
DENSE = 0.01


def _packed(kind: str):
    """(vec_id, array) to (vec_id, vec, dims): a usable vector as bytes of its own number type, else null."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for vector in batch.column(1):
                values = vector.values.to_numpy(zero_copy_only=False).astype(kind) if vector.is_valid else np.zeros(0)
                norm = np.linalg.norm(values.astype(np.float64)) if len(values) and np.isfinite(values).all() else 0
                good = 0 < norm < np.inf
                out.append((values + 0).tobytes() if good else None)
                dims.append(len(values) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], ["vec_id", "vec", "dims"]
            )

    return packed


def _units(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a column, scaled to length one in double precision."""
    joined = b"".join(column.to_pylist())
    kind = "f4" if len(joined) == 4 * dims * len(column) else "f8"
    raw = np.frombuffer(joined, kind).reshape(-1, dims).astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1)[:, None]


def _moments(dims: int):
    """(vec) to (i, j, value): sums of products of coordinates of the unit vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            units = _units(batch.column(0), dims)
            total += units.T @ units
        i, j = np.indices((dims, dims)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "value"])

    return moments


def rotation(classes: DataFrame, dims: int, blocks: int) -> np.ndarray:
    """Orthogonal axes of the vectors, by falling variance dealt out to the blocks in turn, block after block."""
    table = np.zeros((dims, dims))
    sums = classes.select("vec").mapInArrow(_moments(dims), "i int, j int, value double")
    for i, j, value in sums.groupBy("i", "j").agg(F.sum("value")).collect():
        table[i, j] = value
    axes = np.linalg.eigh((table + table.T) / 2)[1][:, ::-1]
    return np.concatenate([axes[:, b::blocks] for b in range(blocks)], axis=1)


def _edges(dims: int, blocks: int) -> list[tuple[int, int]]:
    """First and last coordinate of each block in the rotated order."""
    sizes = [len(range(b, dims, blocks)) for b in range(blocks)]
    ends = np.cumsum(sizes)
    return [(int(e - s), int(e)) for s, e in zip(sizes, ends)]


def _cells(axes: np.ndarray, blocks: int, budget: float, with_vec: bool):
    """(key, n, vec) to one row for each block and cell that a vector lives in (home) or reaches (not home).

    Two vectors within the radius in a block meet in one cell: the one of the two home cells that is later.
    """
    dims = len(axes)
    radius = float(np.sqrt(budget + SLACK))
    side = 2 * radius

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turned = _units(batch.column(2), dims) @ axes
            rows, block_of, cell_of, home_of = [], [], [], []
            for block, (a, b) in enumerate(_edges(dims, blocks)):
                grid = turned[:, a : min(b, a + GRID_DIMS)]
                own = np.floor(grid / side).astype(np.int64)
                low = np.floor((grid - radius) / side).astype(np.int64)
                high = np.floor((grid + radius) / side).astype(np.int64)
                # A reach is at most one cell to either side, as cells are as wide as the reach.
                for step in np.ndindex(*[3] * grid.shape[1]):
                    cell = own + (np.array(step) - 1)
                    inside = ((cell >= low) & (cell <= high)).all(axis=1)
                    code = np.zeros(len(own), np.int64)
                    mine = np.zeros(len(own), np.int64)
                    for k in range(grid.shape[1]):
                        code = code * (1 << 20) + cell[:, k] + (1 << 19)
                        mine = mine * (1 << 20) + own[:, k] + (1 << 19)
                    take = np.flatnonzero(inside & (code >= mine))
                    rows.append(take)
                    block_of.append(np.full(len(take), block, np.int32))
                    cell_of.append(code[take])
                    home_of.append(code[take] == mine[take])
            rows = pa.array(np.concatenate(rows))
            names = ["key", "n", "block", "cell", "home"]
            columns = [
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(np.concatenate(block_of)),
                pa.array(np.concatenate(cell_of)),
                pa.array(np.concatenate(home_of)),
            ]
            made = pa.RecordBatch.from_arrays(columns, names)
            if not with_vec:
                yield made
                continue
            for at in range(0, len(rows), 8192):
                part = made.slice(at, 8192)
                vec = batch.column(2).take(rows.slice(at, 8192))
                yield pa.RecordBatch.from_arrays([*part.columns, vec], [*names, "vec"])

    return cells


def _links(axes: np.ndarray, blocks: int, budget: float, least: float):
    """The rows of one task to (u, v, links): links of each vector (v null), and each to the least it is joined to."""
    dims = len(axes)
    spans = _edges(dims, blocks)

    def distances(x: np.ndarray, y: np.ndarray, block: int) -> np.ndarray:
        a, b = spans[block]
        x, y = x[:, a:b], y[:, a:b]
        return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)

    def factors(turned: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Single-precision factors whose product is the squared distance in the block."""
        own = turned[:, slice(*spans[block])]
        norms, ones = (own * own).sum(1)[:, None], np.ones((len(own), 1))
        return np.hstack([-2 * own, norms, ones]).astype(np.float32), np.hstack([own, ones, norms]).astype(np.float32)

    def verified(x, y, tx, ty, near, block):
        """Of the proposed pairs those of the cosine, each only in the first block in whose radius it lies."""
        if near.mean() > DENSE:
            near &= distances(tx, ty, block) <= budget + SLACK
            for earlier in range(block):
                near &= distances(tx, ty, earlier) > budget + SLACK
            return np.nonzero(near & (x @ y.T >= least))
        i, j = np.divmod(np.flatnonzero(near), near.shape[1])
        for other in range(block + 1):
            a, b = spans[other]
            apart = tx[i, a:b] - ty[j, a:b]
            inside = (apart * apart).sum(1) <= budget + SLACK
            i, j = (i[inside], j[inside]) if other == block else (i[~inside], j[~inside])
        linked = np.einsum("ij,ij->i", x[i], y[j]) >= least
        return i[linked], j[linked]

    def join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """`root` (each row's least joined row) after the links i to j."""
        while True:
            one, two = root[i], root[j]
            apart = one != two
            if not apart.any():
                return root
            i, j, one, two = i[apart], j[apart], one[apart], two[apart]
            np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
            while (root[root] != root).any():
                root = root[root]

    def links(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        block, pair = rows["block"][0].as_py(), rows["pair"][0].as_py()
        left = rows["left"].to_numpy()
        keys, copies = rows["key"].to_numpy(), rows["n"].to_numpy()
        units = _units(rows["vec"], dims)
        turned = units @ axes
        one, two = np.flatnonzero(left), np.flatnonzero(~left)
        same = pair.startswith("=")
        if same:
            two = one
        counts = np.zeros(len(keys), np.int64)
        root = np.arange(len(keys))
        ahead, behind = factors(turned, block)
        limit = np.float32(budget + SINGLE_SLACK)
        for p in range(0, len(one), TILE_ROWS):
            for q in range(p if same else 0, len(two), TILE_ROWS):
                i, j = one[p : p + TILE_ROWS], two[q : q + TILE_ROWS]
                near = ahead[i] @ behind[j].T <= limit
                if same and p == q:
                    near &= np.triu(np.ones(near.shape, bool), 1)
                if not near.any():
                    continue
                p_at, q_at = verified(units[i], units[j], turned[i], turned[j], near, block)
                one_at, two_at = i[p_at], j[q_at]
                counts += np.bincount(one_at, copies[two_at], len(keys)).astype(np.int64)
                counts += np.bincount(two_at, copies[one_at], len(keys)).astype(np.int64)
                root = join(root, one_at, two_at)
        moved = np.flatnonzero(root != np.arange(len(root)))
        some = np.flatnonzero(counts)
        return pa.table(
            {
                "u": pa.array(np.concatenate([keys[some], keys[moved]])),
                "v": pa.array([None] * len(some) + keys[root[moved]].tolist(), pa.int64()),
                "links": pa.array(np.concatenate([counts[some], np.zeros(len(moved), np.int64)])),
            }
        )

    return links


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95, blocks: int = 4
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors`.

    Unit vectors of cosine c are sqrt(2 - 2 c) apart, and rotation keeps distances. The rotated coordinates are split
    into blocks; if all blocks of a pair exceeded their equal part of the squared distance, so would the whole, so
    every link lies within the part's radius in some block. Each block is joined by range on a grid over its
    widest coordinates; cells of many vectors are compared side by side in bounded pieces. A proposed pair is
    verified in double precision, in the first block that proposes it, and counted there; the pairs themselves never
    become rows: a task returns each vector's number of links and one vector that it is joined to.

    Equal vectors are one vector with a number of copies from the start. Vectors that are null, zero, or hold null or
    non-finite components link with nothing. Only vectors of one length are compared, each length by a join of its
    own. Rows that repeat a vec_id count as rows of their own. A null vec_id never names a component, and such rows are kept. Extra
    columns are ignored.
    """
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    source = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vec_col).cast("array<float>" if single else "array<double>").alias("embedding"),
    )
    rows = source.mapInArrow(_packed("f4" if single else "f8"), "vec_id long, vec binary, dims int")
    # A vector alone of its length links with nothing.
    lengths = rows.where("dims is not null").groupBy("dims").count().where("count > 1").orderBy("dims").collect()
    rows = rows.withColumn("key", F.when(F.col("dims").isNotNull(), F.xxhash64("dims", "vec")))
    named = nothing = vectors.sparkSession.createDataFrame([], "key long, n_links long, component_id long")
    for length in lengths:
        own = _named(rows.where(F.col("dims") == length["dims"]), length["dims"], cosine, blocks)
        named = own if named is nothing else named.union(own)
    out = rows.select("vec_id", "key").join(named, "key", "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )


def _named(rows: DataFrame, dims: int, cosine: float, blocks: int) -> DataFrame:
    """(key, n_links, component_id) of the distinct vectors of one length."""
    classes = settle(
        rows.where("key is not null")
        .groupBy("key", "vec")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("vec_id"))
        .select("key", "n", "vec", "vec_id")
    )
    blocks = min(blocks, dims)
    budget = (2 - 2 * cosine) / blocks
    axes = rotation(classes, dims, blocks)
    shape = "key long, n long, block int, cell long, home boolean"
    placed = classes.select("key", "n", "vec")
    sizes = placed.mapInArrow(_cells(axes, blocks, budget, False), shape).groupBy("block", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / F.lit(SIDE_ROWS)).cast("int").alias("homes"),
        F.ceil(F.sum((~F.col("home")).cast("int")) / F.lit(SIDE_ROWS)).cast("int").alias("guests"),
    )
    dealt = (
        placed.mapInArrow(_cells(axes, blocks, budget, True), shape + ", vec binary")
        .join(sizes.where("homes > 0"), ["block", "cell"])
        .withColumn("part", F.expr("cast(pmod(xxhash64(key), if(home, homes, guests)) as int)"))
        .withColumn(
            "turn",
            # Homes: against their own part, against the other parts (left of later ones), against each part of guests.
            F.expr(
                """if(home,
                     concat(
                       transform(sequence(0, homes - 1), o -> struct(
                         if(o = part, concat('=', part), concat(least(o, part), '/', greatest(o, part))) as pair,
                         part <= o as left)),
                       if(guests = 0, array(), transform(sequence(0, guests - 1), g -> struct(
                         concat(part, '<', g) as pair, true as left)))),
                     transform(sequence(0, homes - 1), o -> struct(concat(o, '<', part) as pair, false as left)))"""
            ),
        )
        .select("block", "cell", "key", "n", "vec", F.inline("turn").alias("pair", "left"))
    )
    met = settle(
        dealt.groupBy("block", "cell", "pair").applyInArrow(
            _links(axes, blocks, budget, cosine), "u long, v long, links long"
        )
    )
    counted = met.where("v is null").groupBy(F.col("u").alias("key")).agg(F.sum("links").alias("links"))
    joined = components(met.where("v is not null").select("u", "v"))
    named = (
        classes.select("key", "n", "vec_id")
        .join(counted, "key", "left")
        .join(joined.withColumnRenamed("node", "key"), "key", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "key").alias("component"),
            "vec_id",
        )
    )
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "component").select("key", "n_links", "component_id")
