"""Logistic regression on sparse rows, solved to the optimum.

L-BFGS on the stated objective, features unscaled. Every step is one pass: each
partition sums losses and gradients of all problems that share the rows, the
partial sums are added slice by slice, and the driver holds coefficients and a
bounded sample of rows. The sample only shapes the directions of the search: its
Hessian stands in for that of all rows, so that far fewer passes are needed.
A fit ends when the gradient over all rows has all but vanished, never by a step limit.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize, scratch_path

TOLERANCE = 1e-9   # of the gradient at the start
GIVE_UP = 5000     # passes after which a fit that has not converged raises
SLICES = 16
DIRECT_BYTES = 1 << 26      # of partial sums that come to the driver in one pass
BLOCK_ENTRIES = 1 << 17     # of a block, so that what is made of one stays in the cache of a core
GROUP_BYTES = 1 << 22       # of the row groups of blocks, between which Spark can split a file
SAMPLE_ROWS = 1024          # at most, of the rows that shape the search
SAMPLE_ENTRIES = 1 << 23    # about as many stored entries in them
SAMPLE_CELLS = 1 << 22      # of the matrices that are kept for all problems
PAST_CELLS = 1 << 24        # of the steps that are remembered for all problems
_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


@dataclass(frozen=True)
class LinearFit:
    """One row of weights per class, or one row for two classes; the last weight is the intercept."""

    weights: np.ndarray

    @property
    def coefficients(self) -> np.ndarray:
        return self.weights[0]


def hold_features(df: DataFrame) -> DataFrame:
    """Write a frame with a vector column `features` once and read it back as `size`, `indices` and `values`.

    The many passes of a fit then start from a file scan; otherwise every pass
    ships the vocabularies and builds the vectors again.
    """
    if "features" not in df.columns:
        return df
    held = materialize(df, "features")
    path = held.inputFiles()
    if not path:
        return df.sparkSession.createDataFrame([], ", ".join(
            [*[f"`{n}` {t}" for n, t in df.drop("features").dtypes], "size int", "indices array<int>", "values array<double>"]))
    kinds = ", ".join(f"`{n}` {_VECTOR if n == 'features' else t}" for n, t in df.dtypes)
    plain = df.sparkSession.read.schema(kinds).parquet(*path)
    size = F.coalesce("features.size", F.size("features.values"))
    return plain.select(
        *[c for c in df.columns if c != "features"], size.alias("size"),
        F.coalesce("features.indices", F.sequence(F.lit(0), F.size("features.values") - 1)).alias("indices"), "features.values")


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, column number and value of every stored entry."""
    indices, values = batch.column(0), batch.column(1)
    count = np.diff(indices.offsets.to_numpy())
    return np.repeat(np.arange(batch.num_rows), count), indices.flatten().to_numpy(), values.flatten().to_numpy()


def _margins(batch: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    row, column, value = _rows(batch)
    return np.stack([np.bincount(row, value * w[column], minlength=batch.num_rows) for w in weights], axis=1)


@dataclass(frozen=True)
class Scales:
    """How tf-idf vectors are made of counts: an entry is a count times the `factor` of its column times a number that all
    entries of its row share between two of the columns `starts`."""

    factor: np.ndarray
    starts: np.ndarray

    def split(self, count: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(entries per part of a row, the shared number of each part, counts), or None if the entries are not made so."""
        parts = len(count) * len(self.starts)
        part = np.repeat(np.arange(len(count)), count) * len(self.starts) + np.searchsorted(self.starts, column, "right") - 1
        if not len(value) or (value <= 0).any() or (np.diff(part) < 0).any():
            return None
        rest, shared = value / self.factor[column], np.full(parts, np.inf)
        np.minimum.at(shared, part, rest)
        ratio, counts, open_ = rest / shared[part], np.zeros(len(value)), np.ones(parts, bool)
        for least in range(1, 9):  # the smallest count of the part
            near = np.rint(ratio * least)
            off = np.bincount(part, np.abs(ratio * least - near) > 1e-9 * near, parts) > 0
            counts = np.where((open_ & ~off)[part], near, counts)
            shared[open_ & ~off] /= least
            open_ &= off
            if not open_.any():
                break
        if open_.any() or counts.max() >= 1 << 16:
            return None
        return np.bincount(part, minlength=parts).astype(np.int32), np.where(np.isinf(shared), 0.0, shared), counts.astype(np.uint16)


@dataclass(frozen=True)
class _Block:
    """Some rows of a fit: the entries one after the other, `about` numbers on each row, and the number of entries per row.

    If there are numbers `shared` by parts of rows, `count` is the number of entries of each part, and entries are still to be
    multiplied with them and with the `factor` of their column.
    """

    count: np.ndarray
    column: np.ndarray
    value: np.ndarray
    about: np.ndarray
    shared: np.ndarray | None = None
    factor: np.ndarray | None = None

    @property
    def size(self) -> int:
        return len(self.about)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Products of all rows with every row of weights, (rows of weights, rows)."""
        out, there = np.zeros((len(weights), len(self.count))), self.count > 0
        if len(self.column):
            starts = (np.cumsum(self.count) - self.count)[there]
            for k, w in enumerate(weights):
                w = w if self.factor is None else w * self.factor
                out[k, there] = np.add.reduceat(self.value * w[self.column], starts)
        if self.shared is not None and self.size:
            out = (out * self.shared).reshape(len(weights), self.size, -1).sum(axis=2)
        return out

    def back(self, slope: np.ndarray, width: int) -> np.ndarray:
        """The sum of the rows, each times its `slope`."""
        if self.shared is not None and self.size:
            slope = np.repeat(slope, len(self.count) // self.size) * self.shared
        total = np.bincount(self.column, self.value * np.repeat(slope, self.count), minlength=width)
        return total if self.factor is None else total * self.factor

    def rows(self, taken: np.ndarray) -> tuple[np.ndarray, ...]:
        """(entries per row, columns, values, about) of the taken rows, the values multiplied out."""
        value, count = self.value, self.count
        if self.shared is not None and self.size:
            value = value * np.repeat(self.shared, self.count) * self.factor[self.column]
            count = count.reshape(self.size, -1).sum(axis=1)
        of = np.repeat(taken, count)
        return count[taken].astype(np.int32), self.column[of].astype(np.int32), value[of].astype(float), self.about[taken]


@dataclass(frozen=True)
class _Rows:
    """The packed rows of a fit, and how many numbers a row has."""

    blocks: DataFrame
    width: int
    numbers: int
    scales: Scales | None
    tasks: int

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
        for batch in batches:
            for cells in zip(*(c for c in batch.columns)):
                count, column, value, about, shared = (c.as_buffer() for c in cells)
                scaled = len(shared) > 0
                yield _Block(
                    np.frombuffer(count, np.int32), np.frombuffer(column, _column_kind(self.width)).astype(np.intp),
                    np.frombuffer(value, np.uint16 if scaled else float), np.frombuffer(about, float).reshape(-1, self.numbers),
                    np.frombuffer(shared, float) if scaled else None, self.scales.factor if scaled else None)

    def run(self, make: Callable[[Iterator[_Block]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        width, numbers, scales = self.width, self.numbers, self.scales
        return self.blocks.mapInArrow(lambda batches: make(_Rows(None, width, numbers, scales, 0).read(batches)), schema)


def _column_kind(width: int) -> type:
    return np.uint16 if width <= 1 << 16 else np.int32


@contextmanager
def _packed(features: DataFrame, about: Sequence[Column], scales: Scales | None) -> Iterator[_Rows]:
    """The features and some numbers on each row, written once with many rows packed into one.

    Every pass reads all entries again; packed, they go from the file to numpy as they lie, without a step per entry, and
    tf-idf vectors take four bytes per entry. The tasks of a pass are as many as there are cores, so that its partial
    sums are few. The file is deleted after the fit.
    """
    width, kept = _width(features), ["features"] if "features" in features.columns else ["indices", "values"]
    names = ["count", "column", "value", "about", "shared"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_columns == 2:
                vectors = batch.column(0)
                indices, values = (vectors.field(i) for i in (2, 3))
                if vectors.field(0).to_numpy().any():  # dense vectors have no indices
                    indices = pa.array([range(len(v)) if i is None else i for i, v in zip(indices.to_pylist(), values.to_pylist())], indices.type)
            else:
                indices, values = batch.columns[:2]
            sizes = pc.fill_null(pc.list_value_length(indices), 0).to_numpy()
            ends = np.cumsum(sizes)
            cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_ENTRIES)) + 1), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                i, v, a = (x.slice(low, high - low).flatten().to_numpy() for x in (indices, values, batch.columns[-1]))
                count, shared = sizes[low:high].astype(np.int32), np.zeros(0)
                if scales is not None and (found := scales.split(count, i, v)) is not None:
                    count, shared, v = found
                cells = [count, i.astype(_column_kind(width)), v, a, shared]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], names=names)

    spark, path = features.sparkSession, scratch_path(features.sparkSession, "fit-blocks")
    schema = ", ".join(f"{n} binary" for n in names)
    rows = features.select(*kept, F.array(*[a.cast("double") for a in about]).alias("about"))
    written = rows.mapInArrow(pack, schema).write.option("parquet.block.size", GROUP_BYTES)
    written.option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1).parquet(path)
    try:
        blocks = spark.read.schema(schema).parquet(path).coalesce(max(1, spark.sparkContext.defaultParallelism))
        yield _Rows(blocks, width, len(about), scales, blocks.rdd.getNumPartitions())
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _summed(rows: _Rows, part: Callable[[_Block], np.ndarray], length: int) -> np.ndarray:
    """The sum of `part` over all blocks. Short sums come to the driver task by task, long ones are added slice by slice before."""
    slices = 1 if length * 8 * rows.tasks <= DIRECT_BYTES else SLICES
    cuts = np.linspace(0, length, slices + 1).astype(int)

    def sums(blocks: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for block in blocks:
            total += part(block)
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(range(slices), pa.int32()),
            "sum": pa.array([total[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in sorted(table.column("sum").to_pylist()))
        return pa.table({"slice": table.column("slice").slice(0, 1), "sum": pa.array([total.tobytes()], pa.binary())})

    found = rows.run(sums, "slice int, sum binary")
    if slices == 1:
        return sum((np.frombuffer(x, np.float64) for x in sorted(r["sum"] for r in found.collect())), np.zeros(length))
    found = found.groupBy("slice").applyInArrow(add, "slice int, sum binary").collect()
    return np.concatenate([np.frombuffer(r["sum"], np.float64) for r in sorted(found, key=lambda r: r["slice"])])


class _Sample:
    """Some rows of a fit, whose Hessian stands in for that of all rows.

    With A the rows and D their curvatures, scaled up to all rows, the Hessian is 1 + A'DA per block of weights. Its few
    large curvatures are alike in the sample and in all rows and are taken as they are; the many small ones belong to
    single rows of the sample, and one value in their middle is taken for every other direction. `curvature` gives D of every
    block, (blocks, rows), from the margins (rows of weights, rows) and what is known about the rows.
    """

    def __init__(self, rows: _Rows, problems: int, curvature: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        def sizes(blocks: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
            for block in blocks:
                yield pa.RecordBatch.from_pydict({"rows": [block.size], "entries": [len(block.column)]})

        width = rows.width
        n, entries = rows.run(sizes, "rows long, entries long").agg(F.sum("rows"), F.sum("entries")).first()
        most = min(SAMPLE_ROWS, int((SAMPLE_CELLS / problems) ** 0.5), 1 + SAMPLE_ENTRIES * (n or 0) // max(1, entries or 1))
        share = most / max(1, n or 0)

        def pick(blocks: Iterator[_Block]) -> Iterator[pa.RecordBatch]:
            for block in blocks:
                taken = np.random.default_rng(zlib.crc32(block.column.tobytes())).random(block.size) < share
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in block.rows(taken)], names=["count", "column", "value", "about"])

        found = rows.run(pick, "count binary, column binary, value binary, about binary").toArrow()
        found = found.sort_by([(c, "ascending") for c in found.column_names])
        count, column, value, about = (
            np.concatenate([np.zeros(0, t), *[np.frombuffer(x, t) for x in found.column(c).to_pylist()]])
            for c, t in zip(found.column_names, (np.int32, np.int32, float, float)))
        if len(count) > 2 * most:  # hardly ever: the rows are drawn one by one
            count, about = count[:2 * most], about[:2 * most * (len(about) // len(count))]
            column, value = column[:count.sum()], value[:count.sum()]
        self.size, self.width, self.curvature, self.inverse = len(count), width, curvature, None
        if not self.size:
            return
        self.scale = n / self.size
        self.block = _Block(count, column.astype(np.intp), value, about.reshape(self.size, -1))
        row = np.repeat(np.arange(self.size), count)
        self.products = np.zeros((self.size, self.size))
        order = np.argsort(column, kind="stable")
        starts = range(0, width, SAMPLE_ROWS)
        cuts = np.searchsorted(column[order], [*starts, width])
        for start, low, high in zip(starts, cuts, cuts[1:]):
            at = order[low:high]
            cells = np.bincount(row[at] * SAMPLE_ROWS + column[at] - start, value[at], self.size * SAMPLE_ROWS).reshape(self.size, -1)
            self.products += cells @ cells.T

    def take(self, weights: np.ndarray, blocks: Sequence[int]) -> None:
        """From now on the Hessian of these blocks is that at these rows of weights."""
        if not self.size:
            return
        self.inverse = self.inverse or {}
        for block, d in zip(blocks, self.curvature(self.block.margins(weights), self.block.about, blocks)):
            d = self.scale * np.nan_to_num(d)
            root = np.sqrt(d)
            values, vectors = np.linalg.eigh(root[:, None] * self.products * root)
            noise = (1 - 1 / self.scale) * float(d @ np.diag(self.products)) / self.size  # of a row in a direction of its own
            large = values > max(2 * noise, 1e-9)
            rest = 1 + noise
            # in terms of the sample's rows, so that A'(part) are orthonormal directions
            part = root[:, None] * vectors[:, large] / np.sqrt(values[large])
            self.inverse[block] = rest, part, 1 / (1 + values[large]) - 1 / rest

    def solve(self, g: np.ndarray, block: int) -> np.ndarray:
        if self.inverse is None:
            return g
        rest, part, change = self.inverse[block]
        return g / rest + self.block.back(part @ (change * (part.T @ self.block.margins(g[None, :])[0])), self.width)


def minimise(evaluate: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], problems: int, length: int,
             tolerance: float = TOLERANCE, memory: int = 12, sample: _Sample | None = None) -> np.ndarray:
    """Minima of several smooth convex functions in lockstep.

    `evaluate` gives values and gradients of the functions with the given numbers, at one row of weights for each. Functions
    that have reached their minimum are not evaluated any more. ``sample`` replaces the plain gradient by one through its
    Hessian, renewed after 3 passes, 6, 12 and so on.
    """
    per = 1 if sample is None else length // sample.width

    def through(p: int, v: np.ndarray) -> np.ndarray:
        return v if sample is None else np.concatenate([sample.solve(x, p * per + k) for k, x in enumerate(v.reshape(per, -1))])

    def renewed(which: np.ndarray) -> None:
        if sample is not None:
            sample.take(w[which].reshape(-1, sample.width), [int(p) * per + k for p in which for k in range(per)])

    memory = max(memory, min(40, PAST_CELLS // (2 * problems * length)))
    w = np.zeros((problems, length))
    renewed(np.arange(problems))
    f, g = evaluate(w, np.arange(problems))
    goal = tolerance * np.maximum(1e-12, np.linalg.norm(g, axis=1))
    past: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(problems)]
    step = 1 / np.maximum(1.0, np.linalg.norm(g, axis=1)) if sample is None else np.ones(problems)
    way = -np.stack([through(p, x) for p, x in enumerate(g)])
    renew = 3
    for passes in range(GIVE_UP):
        open_ = np.flatnonzero(np.linalg.norm(g, axis=1) > goal)
        if not len(open_):
            return w
        if passes == renew:
            renewed(open_)
            renew *= 2
        trial = w[open_] + step[open_, None] * way[open_]
        for p, tried, value, slopes in zip(open_, trial, *evaluate(trial, open_)):
            slope = float(g[p] @ way[p])
            flat = 1e-13 * max(1.0, abs(f[p]))  # below this the values are rounding, and the gradient decides
            good = value <= f[p] + 1e-4 * step[p] * slope + flat
            if not good:
                step[p] /= 4
                if step[p] < 1e-12 and (past[p] or sample is not None):
                    past[p], way[p], step[p] = [], -g[p], 1 / max(1.0, float(np.linalg.norm(g[p])))
                continue
            s, y = tried - w[p], slopes - g[p]
            if s @ y > 1e-16 * float(s @ s):
                past[p] = [*past[p][1 - memory:], (s, y)]
            w[p], f[p], g[p] = tried, value, slopes
            way[p], step[p] = -_two_loops(g[p], past[p], lambda v, p=p: through(p, v)), 1.0
    raise RuntimeError("the fit did not converge")


def _two_loops(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]], through: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    q, kept = g.copy(), []
    for s, y in reversed(past):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    q = through(q)
    if past:
        s, y = past[-1]
        q *= (s @ y) / (y @ through(y))
    for (s, y), a in zip(past, reversed(kept)):
        q += (a - (y @ q) / (s @ y)) * s
    return q


def _width(rows: DataFrame) -> int:
    first = rows.select("features" if "features" in rows.columns else "size").first()
    if first is None:
        raise ValueError("no rows to fit on")
    return first[0] if isinstance(first[0], int) else first[0].size


def fit_binary(features: DataFrame, sides: Sequence[tuple[Column, Column]], cs: Sequence[float], scales: Scales | None = None) -> list[LinearFit]:
    """Minimise |w|²/2 + C·Σ (positive·loss(1) + negative·loss(0)) for several weightings of the same rows.

    ``sides`` names, per problem, the weight with which a row counts as positive and as negative.
    ``scales`` tells how the features were made, so that they take less room; without it, or if it does not hold, they are kept as they come.
    """
    n, c = len(cs), np.asarray(cs, float)

    def curvature(margins: np.ndarray, about: np.ndarray, problems: Sequence[int]) -> np.ndarray:
        chance = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
        return c[problems, None] * (about[:, :n] + about[:, n:]).T[problems] * chance * (1 - chance)

    with _packed(features, [s[i] for i in range(2) for s in sides], scales) as rows:
        width = rows.width

        def evaluate(w: np.ndarray, problems: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            def part(block: _Block) -> np.ndarray:
                out = np.zeros((len(problems), width + 1))
                for k, (p, m) in enumerate(zip(problems, block.margins(w))):
                    positive, negative = block.about[:, p], block.about[:, n + p]
                    out[k, 0] = positive @ np.logaddexp(0, -m) + negative @ np.logaddexp(0, m)
                    chance = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
                    out[k, 1:] = block.back(negative * chance - positive * (1 - chance), width)
                return out.ravel()

            total = _summed(rows, part, len(problems) * (width + 1)).reshape(len(problems), width + 1)
            return 0.5 * (w * w).sum(axis=1) + c[problems] * total[:, 0], w + c[problems, None] * total[:, 1:]

        sample = _Sample(rows, n, curvature)
        return [LinearFit(row[None, :]) for row in minimise(evaluate, n, width, sample=sample)]


def fit_classes(features: DataFrame, label: str, classes: int, c: float = 1.0, scales: Scales | None = None) -> LinearFit:
    """Minimise |w|²/2 + C·Σ softmax loss over classes 0, 1, ...; the last weight, the intercept, is not penalised."""
    def curvature(margins: np.ndarray, about: np.ndarray, problems: Sequence[int]) -> np.ndarray:
        chance = np.exp(margins - margins.max(axis=0))
        chance /= chance.sum(axis=0)
        return c * chance * (1 - chance)

    with _packed(features, [F.col(label)], scales) as rows:
        width = rows.width
        free = np.ones(width)
        free[-1] = 0.0

        def evaluate(flat: np.ndarray, problems: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            w = flat.reshape(classes, width)

            def part(block: _Block) -> np.ndarray:
                y, m = block.about[:, 0].astype(int), block.margins(w).T
                top = m.max(axis=1)
                whole = top + np.log(np.exp(m - top[:, None]).sum(axis=1))
                slope = np.exp(m - whole[:, None])
                slope[np.arange(len(y)), y] -= 1
                gradient = [block.back(slope[:, k], width) for k in range(classes)]
                return np.concatenate([[(whole - m[np.arange(len(y)), y]).sum()], *gradient])

            total = _summed(rows, part, 1 + classes * width)
            penalised = w * free
            return (np.array([0.5 * (penalised * w).sum() + c * total[0]]),
                    (penalised.ravel() + c * total[1:])[None, :])

        sample = _Sample(rows, classes, curvature)
        return LinearFit(minimise(evaluate, 1, classes * width, sample=sample).reshape(classes, width))


def with_margins(model: LinearFit, features: DataFrame) -> DataFrame:
    """Adds `margins`, one per row of weights, in place of the features; row by row, nothing is shuffled."""
    held = hold_features(features)
    kept = [c for c in held.columns if c not in ("size", "indices", "values")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = pa.array(list(_margins(batch, model.weights)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i + 2) for i in range(len(kept))], margins], names=[*kept, "margins"])

    schema = ", ".join([*[f"`{n}` {t}" for n, t in held.select(*kept).dtypes], "margins array<double>"])
    return held.select("indices", "values", *kept).mapInArrow(rows, schema)
