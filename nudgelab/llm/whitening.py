"""Whitening of embedding vectors with distributed block matrices.

1. One pass adds up the integer vectors exactly, dimension by dimension.
2. A second pass centres the rows and packs them into blocks, numbered without
   gaps and written once to the shared folder with the ids of their rows.
3. The blocks form an MLlib ``BlockMatrix`` A. ``A' * A`` is the scatter matrix; its products are
   cut along the rows, so that no task holds more than ``PANEL_BLOCKS`` blocks of either factor.
4. The scatter (dimensions squared) is decomposed on the driver, and ``A * W`` with the whitening
   matrix W projects all rows. Rows take their ids back by block number.

The driver holds the sums, the scatter matrix and, as ``BlockMatrix`` does, one key for each
block. Blocks have 1 MB up to twenty thousand of them, and grow to 32 MB beyond: 100 TB of floats are
some six million blocks, about half a gigabyte of keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nudgelab.llm.common import as_batch, quoted
from nudgelab.session import materialize

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Blocks of doubles; they grow with the table up to the larger size, to keep their number down.
BLOCK_BYTES, MOST_BLOCK_BYTES, MANY_BLOCKS = 1_000_000, 32_000_000, 20_000
#: Blocks of either factor that one product task holds.
PANEL_BLOCKS = 8
#: 1024 * c must stay below this for c to have an exact integer form with room for differences.
MOST = float(1 << 61)

_SUMS = "place int, total decimal(38,0), rows long"
_BLOCKS = (
    "part int, local int, ids array<long>, squares array<decimal(38,0)>, "
    "products array<decimal(38,0)>, centred binary"
)
_ROWS = "vec_id long, squares decimal(38,0), products decimal(38,0), whitened array<double>"
_DECIMAL = pa.decimal128(38, 0)


def whitened(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, block_bytes: int | None = None,
) -> DataFrame:
    """Return (vec_id, component, n, deviation, whitened, explained, identity_error).

    Entries c become ``floor(1024 * c) + 100000``. Left out are vectors that are null or hold null
    or non-finite entries (or ones too large for a long), and vectors whose length is not the
    commonest one (ties: the longest), which have no place in the matrix. Every other row counts,
    with repeated and null ids too, and gives one row for each of the first ``components``
    directions (fewer if the vectors are shorter).
    ``deviation`` is the exact sum over dimensions of ``(n * x - S) ** 2`` as decimal(38,0), null
    beyond that. A direction whose variance is rounding error has no whitened coordinate: it is null, and
    ``identity_error`` is that of the others (null if there are none); ``explained`` is null if
    nothing varies. A component's largest entry in size is positive. Empty tables give no rows.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    entries = F.col(quoted(vector_col))
    fits = F.forall(entries, lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < MOST, F.lit(False)))
    usable = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), entries.alias("v")).where(
        F.col("v").isNotNull() & fits & (F.size("v") > 0)
    )
    lengths = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return _result(spark.createDataFrame([], _ROWS), 0, 0, [], None)
    size, n = top["d"], top["n"]
    x = F.transform("v", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = usable.where(F.size("v") == size).select("vec_id", x.alias("x"))
    sums = _sums(rows)
    if block_bytes is None:
        block_bytes = min(MOST_BLOCK_BYTES, max(BLOCK_BYTES, 8 * size * n // MANY_BLOCKS))
    block_rows = max(1, block_bytes // (8 * size))
    packed = rows.coalesce(math.ceil(n / block_rows)).mapInArrow(
        _pack(sums, n, block_rows), _BLOCKS
    )
    blocks = _numbered(materialize(packed))
    matrix = _matrix(blocks, block_rows, size, n)
    scatter = _scatter(matrix)
    values, directions = eigen(scatter / n, min(components, size))
    trace = float(np.trace(scatter)) / n
    projected = materialize(_projected(matrix, blocks, block_rows, values, directions))
    rests = sum((s % n) ** 2 for s in sums)
    shares = [v / trace if trace > 0 else None for v in values]
    known = [j for j, v in enumerate(values) if _varies(v, values, size)]
    return _result(projected, n, rests, shares, identity_error(projected, known))


def eigen(covariance: np.ndarray, components: int) -> tuple[list[float], np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return [max(float(v), 0.0) for v in values], vectors * signs


def identity_error(projected: DataFrame, known: list[int]) -> float | None:
    """Largest absolute entry of the coordinates' covariance minus the identity."""
    if not known:
        return None
    at = lambda j: F.col("whitened")[j]
    entries = [
        F.abs(F.covar_pop(at(i), at(j)) - (1.0 if i == j else 0.0)) for i in known for j in known if i <= j
    ]
    return max(projected.agg(*[e.alias(f"e{k}") for k, e in enumerate(entries)]).first())


def _varies(value: float, values: list[float], size: int) -> bool:
    return value > values[0] * size * np.finfo(float).eps


def _sums(rows: DataFrame) -> list[int]:
    """The exact sum of every dimension."""
    schema = pa.schema([("place", pa.int32()), ("total", _DECIMAL), ("rows", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _table(batch)
            wide = x if int(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object)
            totals = [Decimal(int(t)) for t in wide.sum(axis=0)]
            yield as_batch(
                {"place": np.arange(len(totals)), "total": totals, "rows": [len(x)] * len(totals)},
                schema,
            )

    totals = rows.select("x").mapInArrow(add, _SUMS).groupBy("place").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in totals.orderBy("place").collect()]


def _table(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("x")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _pack(sums: list[int], n: int, block_rows: int):
    """Centred rows in blocks, with what the exact deviation of each row needs.

    With S = n * q + r, ``n * x - S`` is ``n * (x - q) - r``; ``squares`` holds the sum of
    ``(x - q) ** 2`` and ``products`` that of ``(x - q) * r``.
    """
    means, rests = [s // n for s in sums], [s % n for s in sums]
    rest_shares = np.array([r / n for r in rests])
    listed, exact = pa.list_(pa.int64()), pa.list_(_DECIMAL)
    schema = pa.schema([
        ("part", pa.int32()), ("local", pa.int32()), ("ids", listed), ("squares", exact),
        ("products", exact), ("centred", pa.binary()),
    ])

    def sums_of(x: np.ndarray) -> tuple[list, list]:
        apart = x - np.array(means, dtype=np.int64)
        peak, width = int(np.abs(apart).max()), apart.shape[1]
        one = apart if peak * peak * width < 1 << 62 else apart.astype(object)
        two = apart if peak * max(rests) * width < 1 << 62 else apart.astype(object)
        rest = np.array(rests, dtype=np.int64 if two is apart else object)
        pair = (one * one).sum(axis=1), (two * rest).sum(axis=1)
        return apart, *[[Decimal(int(v)) for v in values] for values in pair]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local, held, waiting = TaskContext.get().partitionId(), 0, [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            x = _table(table.combine_chunks().to_batches()[0])
            apart, squares, products = sums_of(x)
            centred = (apart - rest_shares).astype("<f8")
            ids = table.column("vec_id").to_pylist()
            return as_batch(
                {"part": [part], "local": [local], "ids": pa.array([ids], listed),
                 "squares": pa.array([squares], exact), "products": pa.array([products], exact),
                 "centred": [centred.tobytes()]}, schema,
            )

        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block_rows - waiting)
                held.append(taken)
                waiting += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if waiting == block_rows:
                    yield block(pa.Table.from_batches(held))
                    local, held, waiting = local + 1, [], 0
        if held:
            yield block(pa.Table.from_batches(held))

    return run


def _numbered(packed: DataFrame) -> DataFrame:
    """Blocks under gapless numbers; one row for each partition passes the driver."""
    counts = packed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, upto = [], 0
    for row in counts:
        starts.append((row["part"], upto))
        upto += row["n"]
    offsets = packed.sparkSession.createDataFrame(starts, "part int, start int")
    return packed.join(offsets, "part").withColumn("block", F.col("start") + F.col("local"))


def _matrix(blocks: DataFrame, block_rows: int, size: int, n: int) -> BlockMatrix:
    """The centred rows; short blocks are filled up with zero rows, which change no product."""

    def block(row):
        values = np.zeros(block_rows * size)
        given = np.frombuffer(row["centred"], dtype="<f8")
        values[: len(given)] = given
        return (row["block"], 0), DenseMatrix(block_rows, size, values, True)

    grid = blocks.agg(F.max("block")).first()[0] + 1
    matrix = BlockMatrix(
        blocks.select("block", "centred").rdd.map(block), block_rows, size, grid * block_rows, size
    )
    return matrix.persist(StorageLevel.MEMORY_AND_DISK)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """``A' * A``. The product is cut along the rows, which Python's ``multiply`` cannot ask for."""
    blocks = matrix.numRowBlocks
    at_once = matrix.blocks.context.defaultParallelism
    cuts = max(math.ceil(blocks / PANEL_BLOCKS), min(blocks, at_once))
    product = matrix.transpose()._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, cuts
    )
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(
    matrix: BlockMatrix, blocks: DataFrame, block_rows: int, values: list[float], directions: np.ndarray
) -> DataFrame:
    """(vec_id, squares, products, whitened) of all rows by ``A * W``."""
    size, components = directions.shape
    scales = np.array([v**-0.5 if _varies(v, values, size) else 0.0 for v in values])
    unknown = np.array([not _varies(v, values, size) for v in values])
    weights = directions * scales
    context = matrix.blocks.context
    w = context.parallelize([((0, 0), DenseMatrix(size, components, weights.ravel(order="F")))], 1)
    product = matrix.multiply(BlockMatrix(w, size, components, size, components))
    coordinates = product.blocks.map(
        lambda b: (b[0][0], np.ascontiguousarray(b[1].toArray()).astype("<f8").tobytes())
    ).toDF("block int, coordinates binary")
    schema = pa.schema([
        ("vec_id", pa.int64()), ("squares", _DECIMAL), ("products", _DECIMAL),
        ("whitened", pa.list_(pa.float64())),
    ])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c: batch.column(c).slice(k, 1).flatten()  # noqa: B023, E731
                ids = get("ids")
                given = np.frombuffer(batch.column("coordinates")[k].as_buffer(), dtype="<f8")
                given = given.reshape(-1, components)[: len(ids)]
                mask = np.tile(unknown, len(ids))
                flat = pa.array(given.ravel(), mask=mask)
                ends = pa.array(np.arange(0, len(flat) + 1, components, dtype=np.int32))
                yield as_batch(
                    {"vec_id": ids, "squares": get("squares"), "products": get("products"),
                     "whitened": pa.ListArray.from_arrays(ends, flat)}, schema,
                )

    owned = blocks.select("block", "ids", "squares", "products").join(coordinates, "block")
    return owned.mapInArrow(unpack, _ROWS)


def _result(
    projected: DataFrame, n: int, rests: int, shares: list[float | None], error: float | None
) -> DataFrame:
    whole = lambda v: F.lit(Decimal(v)).cast("decimal(38,0)")

    def exact(value: Column) -> Column:
        return value.try_cast("decimal(38,0)")

    squares = exact(F.try_multiply(exact(F.try_multiply(whole(n), whole(n))), F.col("squares")))
    products = exact(F.try_multiply(whole(2 * n), F.col("products")))
    deviation = exact(F.try_add(exact(F.try_subtract(squares, products)), whole(rests)))
    share = F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>")
    place = F.col("place")
    return projected.select(
        "vec_id", deviation.alias("deviation"), F.posexplode("whitened").alias("place", "value")
    ).select(
        "vec_id", (place + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", F.col("value").alias("whitened"), F.get(share, place).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
