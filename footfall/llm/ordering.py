"""Running totals in a global order: one range sort, one number for each partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import own_name, stored


def running(rows: DataFrame, order: list[Column], size: str, name: str) -> tuple[DataFrame, int]:
    """``rows`` with ``name``, the sum of the long column ``size`` over all rows before it in ``order``, and the total.

    Rows go to partitions by ranges of ``order`` and are summed there one after the other; the driver sees one number
    for each partition. Rows that ``order`` holds equal follow each other in any order, so it should end in something
    that tells rows apart. An empty table has the total 0.
    """
    part, inside, base = own_name("part"), own_name("inside"), own_name("base")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{part}` int, `{inside}` long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = so_far + np.cumsum(sizes)
            so_far = int(ends[-1])
            own = [pa.array(np.full(len(sizes), number, np.int32)), pa.array(ends - sizes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, part, inside])

    summed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "in-order")
    totals = sorted(tuple(r) for r in summed.groupBy(part).agg(F.sum(size)).collect())  # one row for each partition
    starts, total = [], 0
    for number, own in totals:
        starts.append((number, total))
        total += own
    bases = rows.sparkSession.createDataFrame(starts, f"`{part}` int, `{base}` long")
    placed = summed.join(F.broadcast(bases), part).withColumn(name, F.col(base) + F.col(inside))
    return placed.drop(part, inside, base), total
