"""Sums of per-row vectors: the one distributed step of the iterative learners.

``tree_sum`` runs a NumPy function on the Arrow batches of every partition and adds its vectors inside the task. Short vectors are then
sent to the driver task by task, as is the one vector of a single task. Long ones are cut into slices, and a grouped Spark stage adds
each slice over the tasks: what reaches the driver is one vector, whatever the number of tasks. ``block_sums`` also finishes each block of
the sum (solves its system) where it was added, so that only the short answers reach the driver.

A fit takes hundreds of sums over one table. The table is planned once, as an RDD of packed Arrow batches, and a sum is a job over
it: planned anew each time, the plans, their metrics and adaptive execution's threads (one an exchange, kept for a minute) would fill
the driver's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, Row

#: Doubles that all tasks together may send to the driver in one sum.
DIRECT = 1 << 16
#: Doubles of a slice of a longer vector.
SLICE = 1 << 14


#: Bytes of a packed batch, about.
PACKED = 1 << 22

#: Packed batches of the tables in use and their partitions, as each step of a fit asks for them again.
_BATCHES: WeakKeyDictionary[DataFrame, tuple[RDD, int]] = WeakKeyDictionary()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        step = max(1, b.num_rows * PACKED // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as out:
                out.write_batch(b.slice(at, step))
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch"])


def _unpacked(rows: Iterable[Row]) -> Iterator[pa.RecordBatch]:
    for r in rows:
        with pa.ipc.open_stream(r["batch"]) as batches:
            yield from batches


def _batches(rows: DataFrame) -> tuple[RDD, int]:
    """(packed batches, partitions) of ``rows``, planned when first asked for; a task for each ``PACKED`` bytes is enough."""
    if rows not in _BATCHES:
        packed = rows.mapInArrow(_packed, "batch binary").rdd
        size = packed.map(lambda r: len(r["batch"])).sum()
        packed = packed.coalesce(max(1, -(-size // PACKED))).persist(StorageLevel.MEMORY_AND_DISK)  # ends with the table
        _BATCHES[rows] = packed, packed.getNumPartitions()
    return _BATCHES[rows]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An array<double> column without nulls as an (n, dim) matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _added(parts: Iterable[tuple[int, bytes]]) -> bytes:
    """In the order of tasks: the same sum however they finish."""
    vectors = [np.frombuffer(t) for _, t in sorted(parts)]
    total = np.zeros(len(vectors[0]))
    for v in vectors:
        total += v
    return total.tobytes()


def _own_sum(batches: Iterable[pa.RecordBatch], fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    total = np.zeros(size)
    for b in batches:
        if b.num_rows:
            total += fn(b)
    return total


def _task_sums(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> list[tuple[int, bytes]]:
    """(task, sum of its rows), at the driver."""
    return _batches(rows)[0].mapPartitionsWithIndex(lambda task, part: [(task, _own_sum(_unpacked(part), fn, size).tobytes())]).collect()


def _over_tasks(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], blocks: int, size: int) -> RDD:
    """((block, slice), total), a block's ``size`` doubles in slices added over the tasks."""
    batches, tasks = _batches(rows)
    slices = -(-size // SLICE)

    def own(task: int, part: Iterable[Row]) -> Iterator[tuple[tuple[int, int], tuple[int, bytes]]]:
        whole = _own_sum(_unpacked(part), fn, blocks * size).reshape(blocks, size)
        for k in range(blocks):
            for j in range(slices):
                yield (k, j), (task, whole[k, j * SLICE : (j + 1) * SLICE].tobytes())

    return batches.mapPartitionsWithIndex(own).groupByKey(min(blocks * slices, tasks)).mapValues(_added)


def sum_once(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """``tree_sum`` of a few doubles over a table that is summed no second time."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, total = TaskContext.get().partitionId(), _own_sum(batches, fn, size)
        yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["task", "total"])

    got = rows.mapInArrow(own, "task int, total binary").collect()
    return sum((np.frombuffer(r["total"]) for r in sorted(got, key=lambda r: r["task"])), np.zeros(size))


def tree_sum(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of ``rows`` of the ``size`` doubles that ``fn`` returns for a batch."""
    tasks = _batches(rows)[1]
    if tasks <= 1 or size * tasks <= DIRECT:
        return sum((np.frombuffer(total) for _, total in sorted(_task_sums(rows, fn, size))), np.zeros(size))
    got = _over_tasks(rows, fn, 1, size).collect()  # one vector in all
    return np.concatenate([np.frombuffer(total) for _, total in sorted(got)])


def block_sums(
    rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], blocks: int, size: int, finish: Callable[[int, np.ndarray], np.ndarray]
) -> np.ndarray:
    """A row a block: ``finish(block, sum)``, where ``fn`` returns ``blocks`` vectors of ``size`` doubles end to end."""
    batches, tasks = _batches(rows)
    if blocks * size * tasks <= DIRECT:
        sums = tree_sum(rows, fn, blocks * size).reshape(blocks, size)
        return np.stack([finish(k, sums[k]) for k in range(blocks)])
    if tasks == 1:

        def whole(part: Iterable[Row]) -> Iterator[tuple[int, bytes]]:
            sums = _own_sum(_unpacked(part), fn, blocks * size).reshape(blocks, size)
            return ((k, finish(k, sums[k]).tobytes()) for k in range(blocks))

        got = batches.mapPartitions(whole).collect()
    else:

        def end(block: int, parts: Iterable[tuple[int, bytes]]) -> tuple[int, bytes]:
            return block, finish(block, np.concatenate([np.frombuffer(t) for _, t in sorted(parts)])).tobytes()

        sums = _over_tasks(rows, fn, blocks, size).map(lambda x: (x[0][0], (x[0][1], x[1])))
        got = sums.groupByKey(blocks).map(lambda x: end(*x)).collect()
    return np.stack([np.frombuffer(total) for _, total in sorted(got)])


def merged(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], merge: Callable[[np.ndarray, np.ndarray], np.ndarray], none: np.ndarray) -> np.ndarray:
    """``merge`` over all batches of the few doubles that ``fn`` returns for a batch; ``none`` without rows. ``merge`` must not depend on the order."""

    def own(part: Iterable[Row]) -> Iterator[np.ndarray]:
        total = none
        for b in _unpacked(part):
            if b.num_rows:
                total = merge(total, fn(b))
        return iter([total])

    return _batches(rows)[0].mapPartitions(own).treeReduce(merge)


def grouped_parts(rows: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[tuple[tuple, object]]]) -> RDD:
    """(key, the parts that ``fn`` gives it for the batches), in the order of tasks and batches."""
    batches, tasks = _batches(rows)

    def own(task: int, part: Iterable[Row]) -> Iterator[tuple[tuple, tuple[int, int, object]]]:
        for i, b in enumerate(_unpacked(part)):
            if b.num_rows:
                for key, data in fn(b):
                    yield key, (task, i, data)

    return batches.mapPartitionsWithIndex(own).groupByKey(tasks).mapValues(lambda parts: [d for _, _, d in sorted(parts, key=lambda p: p[:2])])


def grouped_answers(
    rows: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[tuple[tuple, bytes]]], finish: Callable[[tuple, list[bytes]], bytes]
) -> list[bytes]:
    """``finish(key, parts)`` of each key of ``grouped_parts``, in the tasks."""
    found = grouped_parts(rows, fn).map(lambda x: (x[0], finish(x[0], x[1])))
    return [answer for _, answer in sorted(found.collect())]  # one short answer a key
