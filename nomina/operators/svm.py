"""Linear SVMs with squared hinge loss, one per class against the rest, solved together.

For a class with labels y = 1 (its rows) or -1 (the others) the objective is

    |w|**2 / 2 + C * sum of s * max(0, 1 - y * (w . x))**2

over all rows, where x ends with a 1 for the intercept, which is regularised like
any coefficient, and s is the class weight for its own rows and 1 for the others.

All classes of a group take their steps in the same passes over the rows: truncated
Newton, that is conjugate gradients on the Hessian of the rows inside the margin, and
a step length that is halved until the objective falls enough. Only those rows have a
part in the Hessian, so each step writes them to a table of their own, with the classes
they are active for, and its products are taken over that table. The gradients are
preconditioned: with the Hessian of a bounded sample of the active rows among the heaviest
terms, whose inverse the driver holds, and with the exact diagonal for all other terms, of
which a sample tells nothing. That changes the number of passes only, the gradients and
the end are taken from all rows. A pass sends the coefficients or directions of the classes
that still move to every task; a task adds up its rows'
part of the gradient (or Hessian product) and sends it in blocks of terms, which
Spark sums. The objective is strongly convex, so a solution with a gradient of norm
g is no farther than g from the optimum; that is the test for the end.

A group has as many classes as keep its coefficients under GROUP_BYTES, so what is
broadcast and what the driver holds is bounded however many classes there are; the
solution is written group by group and never whole in one place. Rows are packed
once, in blocks, to a written table.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.scratch import delete_path, materialise, scratch_path

# Bytes of coefficients of a group, rows (less than 65,536) and entries of a block,
# bytes of blocks in a task, terms of a block of a sum.
GROUP_BYTES, BLOCK_ROWS, PRODUCTS, TASK_BYTES = 32 << 20, 8192, 1_000_000, 16 << 20
SUM_TERMS = 4096
# Rows and entries of the sample, entries of the inverses of a group of classes, how far
# they are drawn to the diagonal, for a term a row.
SAMPLE_ROWS, SAMPLE_PRODUCTS, HEAD_ENTRIES, DRAWN = 8192, 4_000_000, 16_000_000, 0.4
# Products of entries and classes up to which a sample of all active rows is solved itself.
WHOLE_PRODUCTS, SAMPLE_STEPS, SAMPLE_GOAL = 2_000_000, 40, 0.03
# Conjugate gradients end at this share of the gradient, or after so many steps.
FORCING, CG_STEPS = 0.3, 50
# The least fall of the objective for a step, as a share of what the slope promises.
FALL = 1e-4

PACKED = "labels binary, terms binary, counts binary, rows binary, weights binary"
ACTIVE = PACKED + ", active binary"
SUMS = "block int, terms binary, sums binary"


def _blocks(sizes: np.ndarray) -> Iterator[slice]:
    """Rows cut into blocks of BLOCK_ROWS and PRODUCTS at most, or one longer row."""
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = upto[start - 1] if start else 0
        end = int(np.searchsorted(upto, before + PRODUCTS, side="right"))
        end = min(max(end, start + 1), start + BLOCK_ROWS)
        yield slice(start, end)
        start = end


def _packed(labels: np.ndarray, term: np.ndarray, row: np.ndarray, weights: np.ndarray) -> dict[str, list[bytes]]:
    """A block of PACKED, from the term, row and weight of each entry."""
    order = np.argsort(term, kind="stable")
    term = term[order]
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    used, counts = term[starts], np.diff(starts, append=len(term))
    columns = {
        "labels": labels.astype(np.int64), "terms": used.astype(np.int32), "counts": counts.astype(np.int32),
        "rows": row[order].astype(np.uint16), "weights": weights.astype(np.float64)[order],
    }
    return {name: [values.tobytes()] for name, values in columns.items()}


def pack_rows(rows: DataFrame) -> DataFrame:
    """Rows (label_id, terms, weights) as blocks, whose entries are sorted by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for some in _blocks(sizes):
                labels, terms, weights = batch.slice(some.start, some.stop - some.start).columns
                row = np.repeat(np.arange(len(labels)), sizes[some])
                packed = _packed(labels.to_numpy(), terms.flatten().to_numpy(), row, weights.flatten().to_numpy())
                yield pa.RecordBatch.from_pydict(packed)

    return rows.mapInArrow(run, PACKED)


class _Rows:
    """A block of rows. Products are taken class by class, over plain columns."""

    def __init__(self, row: dict):
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.int32)
        self.counts = np.frombuffer(row["counts"], np.int32)
        self.row = np.frombuffer(row["rows"], np.uint16).astype(np.intp)
        self.weights = np.frombuffer(row["weights"])
        if "active" in row:
            bits = np.frombuffer(row["active"], np.uint8).reshape(len(self.labels), -1)
            self.active = np.unpackbits(bits, axis=1).view(bool)

    def place(self) -> np.ndarray:
        """The place of each entry's term among ``terms``."""
        return np.repeat(np.arange(len(self.terms)), self.counts)

    def active_rows(self, on: np.ndarray) -> dict[str, np.ndarray]:
        """The rows that are active for a class, ``on`` by row and class."""
        some = on.any(axis=1)
        kept, number = some[self.row], np.cumsum(some) - 1
        return {
            "labels": self.labels[some], "active": on[some], "weights": self.weights[kept],
            "term": np.repeat(self.terms, self.counts)[kept], "row": number[self.row[kept]],
        }

    def scores(self, coefficients: np.ndarray) -> np.ndarray:
        """Rows times coefficients, whose last row is the intercept."""
        found = np.empty((len(self.labels), coefficients.shape[1]))
        for at in range(coefficients.shape[1]):
            products = np.repeat(coefficients[self.terms, at], self.counts)
            products *= self.weights
            found[:, at] = np.bincount(self.row, products, len(found))
        return found + coefficients[-1]

    def spread(self, by_row: np.ndarray, out: np.ndarray, squared: bool = False) -> None:
        """Add the transposed rows (or their squares) times ``by_row`` to ``out``."""
        out[-1] += by_row.sum(axis=0)
        entries = np.flatnonzero(by_row.any(axis=1)[self.row])
        row, place, weights = self.row[entries], self.place()[entries], self.weights[entries]
        if squared:
            weights = weights * weights
        for at in range(by_row.shape[1]):
            out[self.terms, at] += np.bincount(place, by_row[row, at] * weights, len(self.terms))


def _full_costs(task: dict, labels: np.ndarray) -> np.ndarray:
    """What a row inside the margin costs each class."""
    return task["c"] * np.where(labels[:, None] == task["ids"], task["weights"], 1.0)


def _costs(task: dict, labels: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a row costs each class, zero beyond the margin, and how short of it it is."""
    short = 1 - np.where(labels[:, None] == task["ids"], score, -score)
    cost = _full_costs(task, labels)
    cost[short <= 0] = 0
    return cost, short


def _active_costs(task: dict, block: _Rows) -> np.ndarray:
    """What a row of the active ones costs each class."""
    return np.where(block.active[:, task["classes"]], _full_costs(task, block.labels), 0.0)


def _pass(task: dict, rows: Iterator[_Rows]) -> tuple[np.ndarray, np.ndarray]:
    """A task's part of (loss, gradient of the loss), by class."""
    w = task["w"]
    loss, total = np.zeros(w.shape[1]), np.zeros(w.shape)
    for block in rows:
        cost, short = _costs(task, block.labels, block.scores(w))
        loss += (cost * short * short).sum(axis=0)
        block.spread(-2 * cost * short * np.where(block.labels[:, None] == task["ids"], 1, -1), total)
    return loss, total


def _curve_pass(task: dict, rows: Iterator[_Rows]) -> tuple[np.ndarray, np.ndarray]:
    """A task's part of (nothing, Hessian of the loss times the direction), by class, from
    the rows that are active for one. An empty direction gives the Hessian's diagonal."""
    direction, total = task["direction"], np.zeros((task["size"] + 1, len(task["ids"])))
    for block in rows:
        cost = 2 * _full_costs(task, block.labels)
        place = block.place()
        for at, k in enumerate(task["classes"]):
            entries = np.flatnonzero(block.active[:, k][block.row])
            row, term, x = block.row[entries], place[entries], block.weights[entries]
            by_row = np.where(block.active[:, k], cost[:, at], 0.0)
            if len(direction):
                score = np.bincount(row, direction[block.terms, at][term] * x, len(by_row))
                by_row *= score + direction[-1, at]
            else:
                x = x * x
            total[-1, at] += by_row.sum()
            total[block.terms, at] += np.bincount(term, by_row[row] * x, len(block.terms))
    return np.zeros(len(task["ids"])), total


def _active_blocks(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, list[bytes]]]:
    """What ``active_rows`` found, brought together in full blocks."""
    held, entries, many = [], 0, 0

    def block() -> dict[str, list[bytes]]:
        sizes = [len(h["labels"]) for h in held]
        before = np.repeat(np.cumsum(sizes) - sizes, [len(h["row"]) for h in held])
        labels, active, weights, term, row = (
            np.concatenate([h[name] for h in held]) for name in ("labels", "active", "weights", "term", "row")
        )
        bits = np.packbits(active, axis=1).tobytes()
        return {**_packed(labels, term, row + before, weights), "active": [bits]}

    for found in parts:
        if held and (entries + len(found["row"]) > PRODUCTS or many + len(found["labels"]) > BLOCK_ROWS):
            yield block()
            held, entries, many = [], 0, 0
        if len(found["labels"]):
            held.append(found)
            entries, many = entries + len(found["row"]), many + len(found["labels"])
    if held:
        yield block()


def _inside(task: dict, block: _Rows) -> dict[str, np.ndarray]:
    """The rows of a block that are inside the margin of a class."""
    return block.active_rows(_costs(task, block.labels, block.scores(task["w"]))[0] > 0)


def _picked(share: float, block: _Rows) -> dict[str, np.ndarray]:
    """A share of the rows of a block, the same ones whenever it is read."""
    pick = np.random.default_rng([len(block.labels), len(block.row)]).random(len(block.labels)) < share
    return block.active_rows(block.active & pick[:, None])


def _add_sums(table: pa.Table) -> pa.Table:
    """The sum of the tasks' parts of one block of terms."""
    terms = [np.frombuffer(t, np.int32) for t in table["terms"].to_pylist()]
    sums = [np.frombuffer(s).reshape(len(t), -1) for t, s in zip(terms, table["sums"].to_pylist())]
    every = np.unique(np.concatenate(terms))
    out = np.zeros((len(every), sums[0].shape[1]))
    for t, s in zip(terms, sums):
        out[np.searchsorted(every, t)] += s
    return pa.table({"block": table["block"].slice(0, 1), "terms": [every.tobytes()], "sums": [out.tobytes()]})


class Sample:
    """The Hessian of a group of classes, whose active rows are few enough to be all in the
    sample."""

    def __init__(self, rows: list[_Rows], task: dict):
        self.rows = rows
        self.costs = [_active_costs(task, block) for block in rows]

    def times(self, direction: np.ndarray, classes: np.ndarray) -> np.ndarray:
        total = np.zeros(direction.shape)
        for block, cost in zip(self.rows, self.costs):
            block.spread(cost[:, classes] * block.scores(direction), total)
        return direction + 2 * total

    def solve(self, right: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """About the inverse times ``right``, by conjugate gradients."""
        found, rest, direction = np.zeros_like(right), right.copy(), right.copy()
        size = (rest * rest).sum(axis=0)
        goal = SAMPLE_GOAL**2 * size
        for _ in range(SAMPLE_STEPS):
            if (size <= goal).all():
                break
            product = self.times(direction, classes)
            length = size / np.maximum((direction * product).sum(axis=0), 1e-300)
            found += length * direction
            rest -= length * product
            left = (rest * rest).sum(axis=0)
            direction = rest + left / np.maximum(size, 1e-300) * direction
            size = left
        return found


class Near:
    """About the inverse of the Hessian of some classes of a group. Among the terms of the
    head it is estimated from the sample, drawn to the exact diagonal; of the others
    the diagonal is taken."""

    def __init__(self, rows: list[_Rows], head: np.ndarray, share: float, task: dict, diagonal: np.ndarray):
        self.head, self.diagonal = head, diagonal
        classes, place = task["classes"], np.full(len(diagonal), -1)
        place[head] = np.arange(len(head))
        found = {k: np.zeros((len(head), len(head))) for k in classes}
        for block in rows:
            cost = 2 / share * _active_costs(task, block)
            dense = np.zeros((len(block.labels), len(head)), np.float32)
            dense[:, place[-1]] = 1
            at = place[np.repeat(block.terms, block.counts)]
            dense[block.row[at >= 0], at[at >= 0]] = block.weights[at >= 0]
            for at, k in enumerate(classes):
                used = np.flatnonzero(cost[:, at])
                part = dense[used] * np.sqrt(cost[used, at], dtype=np.float32)[:, None]
                found[k] += part.T @ part
        # The more terms a sampled row has to tell of, the less it is trusted.
        drawn = min(0.5, (1 - share) * DRAWN * len(head) / max(1, sum(len(b.labels) for b in rows)))
        self.inverse = {}
        for k in classes:
            found[k] *= 1 - drawn
            found[k].flat[:: len(head) + 1] += 1 - drawn + drawn * diagonal[head, k]
            self.inverse[k] = np.linalg.inv(found.pop(k))

    def solve(self, right: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """About the inverse times ``right``."""
        found = right / self.diagonal[:, classes]
        found[self.head] = np.stack([self.inverse[k] @ right[self.head, at] for at, k in enumerate(classes)], axis=1)
        return found


def _blocks_of(table: DataFrame, some: Callable[[_Rows], dict[str, np.ndarray]]) -> DataFrame:
    """Some rows of each block, as blocks with the classes that they are active for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (some(_Rows(row)) for batch in batches for row in batch.to_pylist())
        for block in _active_blocks(parts):
            yield pa.RecordBatch.from_pydict(block)

    return table.mapInArrow(run, ACTIVE)


class Problem:
    """The losses of a group of classes over a packed table of rows."""

    def __init__(self, packed: DataFrame, size: int, ids: np.ndarray, weights: np.ndarray, c: float):
        self.packed, self.size, self.ids, self.weights, self.c = packed, size, ids, weights, c
        self.passes, self.active, self.active_path = 0, None, None

    def _task(self, w: np.ndarray, classes: np.ndarray, direction: np.ndarray | None = None) -> dict:
        task = {"c": self.c, "ids": self.ids[classes], "weights": self.weights[classes], "size": self.size, "classes": classes}
        if direction is None:
            return {**task, "w": np.ascontiguousarray(w[:, classes])}
        return {**task, "direction": np.ascontiguousarray(direction[:, classes]) if len(direction) else direction}

    def find_active(self, w: np.ndarray) -> None:
        """Write the rows that are inside the margin of a class, in a pass over all rows,
        and take the sample of them. The Hessian at ``w`` has no others."""
        self.passes += 1
        spark = self.packed.sparkSession
        shared = spark.sparkContext.broadcast(self._task(w, np.arange(len(self.ids))))
        self.drop_active()
        self.active_path = scratch_path(spark, "active")
        _blocks_of(self.packed, lambda block: _inside(shared.value, block)).write.parquet(self.active_path)
        self.active = spark.read.schema(ACTIVE).parquet(self.active_path)
        shared.destroy()
        many = self.active.agg(F.sum(F.length("labels")) / 8, F.sum(F.length("rows")) / 2).first()
        share = min(1.0, SAMPLE_ROWS / max(1, many[0] or 0), SAMPLE_PRODUCTS / max(1, many[1] or 0))
        sample = _blocks_of(self.active, lambda block: _picked(share, block)).toArrow().to_pylist()
        self.take_sample([_Rows(row) for row in sample], share)

    def take_sample(self, sample: list[_Rows], share: float) -> None:
        # The terms that weigh most in the sample; the intercept is one of them.
        self.sample, self.share = sample, share
        mass, many = np.zeros((self.size + 1, 1)), int(np.sqrt(HEAD_ENTRIES / len(self.ids)))
        for block in sample:
            block.spread(np.ones((len(block.labels), 1)), mass, squared=True)
        mass[-1] = np.inf
        self.head = np.sort(np.argsort(-mass[:, 0], kind="stable")[: max(1, many)])

    def drop_active(self) -> None:
        if self.active_path:
            delete_path(self.packed.sparkSession, self.active_path)
        self.active = self.active_path = None

    def run(self, w: np.ndarray, classes: np.ndarray, direction: np.ndarray | None = None):
        """``_pass`` of some classes over all rows or, with a direction, ``_curve_pass``
        over the active ones, summed by Spark."""
        self.passes += 1
        table, one = (self.packed, _pass) if direction is None else (self.active, _curve_pass)
        shared = table.sparkSession.sparkContext.broadcast(self._task(w, classes, direction))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (_Rows(row) for batch in batches for row in batch.to_pylist())
            loss, total = one(shared.value, rows)
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([-1], pa.int32()), "terms": [np.zeros(1, np.int32).tobytes()], "sums": [loss.tobytes()]}
            )
            for block in range(0, len(total), SUM_TERMS):
                some = total[block : block + SUM_TERMS]
                used = np.flatnonzero(some.any(axis=1)).astype(np.int32)
                if len(used):
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int32()), "terms": [used.tobytes()], "sums": [some[used].tobytes()],
                    })

        sums = table.mapInArrow(part, SUMS).groupBy("block").applyInArrow(_add_sums, SUMS)
        loss, total = np.zeros(len(classes)), np.zeros((self.size + 1, len(classes)))
        for row in sums.toArrow().to_pylist():
            terms = np.frombuffer(row["terms"], np.int32)
            values = np.frombuffer(row["sums"]).reshape(len(terms), -1)
            if row["block"] < 0:
                loss = values[0]
            else:
                total[row["block"] + terms] = values
        shared.destroy()
        return loss, total

    def objective(self, w: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The objective and its gradient, by class."""
        loss, gradient = self.run(w, classes)
        own = w[:, classes]
        return 0.5 * (own * own).sum(axis=0) + loss, own + gradient

    def newton_step(self, w: np.ndarray, gradient: np.ndarray, limit: int) -> np.ndarray:
        """Steps of the classes, by preconditioned conjugate gradients; a zero gradient
        gives none. The preconditioner is solved roughly, so directions are made
        conjugate by the change of the rest."""
        step, rest = np.zeros_like(w), -gradient
        goal = FORCING**2 * (rest * rest).sum(axis=0)
        going = np.flatnonzero(goal > 0)
        self.find_active(w)
        if self.share == 1 and sum(len(b.row) for b in self.sample) * len(self.ids) <= WHOLE_PRODUCTS:
            near = Sample(self.sample, self._task(w, np.arange(len(self.ids))))
        else:
            diagonal = np.ones_like(w)
            diagonal[:, going] += self.run(w, going, np.zeros((0, len(going))))[1]
            near = Near(self.sample, self.head, self.share, self._task(w, going), diagonal)
        scaled, direction = np.zeros_like(w), np.zeros_like(w)
        scaled[:, going] = direction[:, going] = near.solve(rest[:, going], going)
        for _ in range(CG_STEPS):
            if not len(going) or self.passes >= limit:
                break
            _, product = self.run(w, going, direction)
            product += direction[:, going]
            size = (rest[:, going] * scaled[:, going]).sum(axis=0)
            length = (rest[:, going] * direction[:, going]).sum(axis=0) / (direction[:, going] * product).sum(axis=0)
            step[:, going] += length * direction[:, going]
            rest[:, going] -= length * product
            far = (rest[:, going] ** 2).sum(axis=0) > goal[going]
            going, product, length, size = going[far], product[:, far], length[far], size[far]
            if len(going):
                scaled[:, going] = near.solve(rest[:, going], going)
                turn = -(scaled[:, going] * length * product).sum(axis=0) / size
                direction[:, going] = scaled[:, going] + turn * direction[:, going]
        return step

    def solve(self, tol: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients by class, and the classes that ``limit`` passes left unsolved."""
        count = len(self.ids)
        w, everyone = np.zeros((self.size + 1, count)), np.arange(count)
        value, gradient = self.objective(w, everyone)
        while True:
            norms = np.sqrt((gradient**2).sum(axis=0))
            far = norms > tol * np.maximum(1, np.sqrt((w * w).sum(axis=0)))
            if not far.any() or self.passes >= limit:
                return w, self.ids[far]
            step = self.newton_step(w, gradient * far, limit)
            slope, length = (gradient * step).sum(axis=0), np.ones(count)
            trying = np.flatnonzero(slope < 0)
            if not len(trying):
                return w, self.ids[far]
            while len(trying) and self.passes < limit:
                found, there = self.objective(w + length * step, trying)
                # What rounding does to the objective is no rise.
                allowed = value[trying] * (1 + 1e-14) + FALL * length[trying] * slope[trying]
                fine = found <= allowed
                done = trying[fine]
                w[:, done] += length[done] * step[:, done]
                value[done], gradient[:, done] = found[fine], there[:, fine]
                trying = trying[~fine]
                length[trying] /= 2
                trying = trying[length[trying] > 1e-12]


def train_linear_svms(
    vectors: DataFrame, weights: DataFrame, size: int, c: float, max_iter: int, tol: float
) -> DataFrame:
    """(label_id, intercept, coefficients) of every class, as a written table.

    ``vectors`` has (label_id, features) with ``size`` features, ``weights`` a row
    (label_id, weight) per class; ``max_iter`` bounds the passes over the rows for a
    group of classes.
    """
    spark = vectors.sparkSession
    classes = sorted((r["label_id"], float(r["weight"])) for r in weights.collect())
    if len(classes) < 2:
        raise ValueError("training needs at least two classes")
    parts = vectors.select("label_id", F.unwrap_udt("features").alias("v"))
    rows = parts.select("label_id", F.col("v.indices").alias("terms"), F.col("v.values").alias("weights"))
    entries = (rows.agg(F.sum(F.size("terms") + 1)).first()[0] or 0) + 1
    packed = materialise(pack_rows(rows.coalesce(1 + 12 * entries // TASK_BYTES)), "problem")
    path = scratch_path(spark, "coefficients")
    group = min(len(classes), max(1, GROUP_BYTES // (8 * (size + 1))))
    for at in range(0, len(classes), group):
        ids, own = (np.array(x) for x in zip(*classes[at : at + group]))
        problem = Problem(packed, size, ids, own, c)
        w, unsolved = problem.solve(tol, max_iter)
        problem.drop_active()
        if len(unsolved):
            warnings.warn(f"classes {unsolved.tolist()}: no convergence in {max_iter} passes", stacklevel=2)
        table = {
            "label_id": pa.array(ids, pa.int64()),
            "intercept": pa.array(w[-1]),
            "coefficients": pa.array(list(np.ascontiguousarray(w[:-1].T)), pa.list_(pa.float64())),
        }
        spark.createDataFrame(pa.table(table)).write.mode("append").parquet(path)
    return spark.read.schema("label_id long, intercept double, coefficients array<double>").parquet(path)
