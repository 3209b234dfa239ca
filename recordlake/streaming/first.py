"""The first arrival of every key in an endless stream, also when an earlier copy comes later."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from recordlake.operators.dedupe import digest, first_by
from recordlake.session import RECOMMENDED_CONF
from recordlake.streaming.progress import observed

KEY, REVISION, GROUP = "_key", "revision", "_group"
# Keys share a call of the processor by a hash; a running stream must not change this number.
GROUPS = 4096
# The state of a group is read at once if it has at most so many keys per key of the batch.
READ_AT_ONCE = 4


class _Earliest(StatefulProcessor):
    """Keeps the place of the earliest row of each key of a group and passes every row that is earlier."""

    def __init__(self, columns: Sequence[str], order_by: Sequence[str], state: StructType, ttl_ms: int | None):
        self.columns, self.order_by, self.state, self.ttl_ms = list(columns), list(order_by), state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("earliest", StructType([StructField(KEY, BinaryType())]), self.state, self.ttl_ms)
        # Keys of the group, forgotten ones included; it has no end, so none means no key yet.
        self.size = handle.getValueState("size", StructType([StructField("n", LongType())]))

    @staticmethod
    def _place(values) -> tuple:
        # Null comes first, as in a sort.
        return tuple((v is not None, v) if v is not None else (False, 0) for v in values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best: dict[bytes, tuple[tuple, Row]] = {}
        for row in rows:
            name = row[KEY] or b""  # a null key; no digest is empty
            place, held = self._place(row[c] for c in self.order_by), best.get(name)
            if held is None or place < held[0]:
                best[name] = place, row
        size = (self.size.get() or (0,))[0]
        if size <= READ_AT_ONCE * len(best):
            old = {k[0]: v for k, v in self.kept.iterator()} if size else {}
            size = len(old)
        else:
            old = {name: self.kept.getValue((name,)) for name in best}
        for name, (place, row) in best.items():
            before, revision = old.get(name), 0
            if before is not None:
                if self._place(before[:-1]) <= place:
                    continue
                revision = before[-1] + 1
            else:
                size += 1
            self.kept.updateValue((name,), (*(row[c] for c in self.order_by), revision))
            yield Row(**{c: row[c] for c in self.columns}, **{KEY: row[KEY], REVISION: revision})
        self.size.update((size,))

    def close(self) -> None:
        pass


def first_arrivals_so_far(
    rows: DataFrame, key: Column, order_by: Sequence[str], keep_ms: int | None = None
) -> DataFrame:
    """Rows of a stream that are the earliest of their key so far, with ``revision``.

    A key's first row passes at once with revision 0. If a later batch brings an earlier copy,
    by ``order_by``, that passes too, with the next revision, and takes the place of the one
    before it; all other copies are dropped. So the last revision of a key is its first
    arrival, whatever the order in which copies come; :func:`last_revisions` reduces what was
    landed to it. State holds a 32-byte digest per key, the place of its row and a number. It
    is kept for good, or for ``keep_ms`` of processing time after it last changed; a key that
    was forgotten starts again at revision 0. Needs the RocksDB state store (see
    :func:`stateful`). Keys are visited in groups by a hash, as a call per key costs more
    than its state does: what is read of the state grows with the keys of the batch. A task
    reads a group's rows of a batch as a stream and holds one per key. Checkpoints from before
    there were groups cannot be resumed.
    """
    marked = rows.withColumn(KEY, digest(key))
    grouped = marked.withColumn(GROUP, F.pmod(F.xxhash64(KEY), F.lit(GROUPS))).groupBy(GROUP)
    state = StructType([rows.schema[c] for c in order_by] + [StructField(REVISION, LongType())])
    out = StructType([*rows.schema.fields, marked.schema[KEY], StructField(REVISION, LongType())])
    return grouped.transformWithState(
        statefulProcessor=_Earliest(rows.columns, order_by, state, keep_ms),
        outputStructType=out, outputMode="Update", timeMode="None" if keep_ms is None else "ProcessingTime",
    )


def last_revisions(landed: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row per key of what :func:`first_arrivals_so_far` passed: the first arrival.

    The place decides, not the revision, so batches that were landed twice and keys that were
    forgotten in between do no harm.
    """
    return first_by(landed, [KEY], order_by).drop(KEY, REVISION)


@contextmanager
def stateful(spark: SparkSession):
    """Queries started inside use the state store that stateful operators need."""
    changed = {k: v for k, v in RECOMMENDED_CONF.items() if ".stateStore." in k}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def land_first_arrivals(
    rows: DataFrame, key: Column, order_by: Sequence[str], path: str, checkpoint: str, keep_ms: int | None = None,
    every: str | None = None,
):
    """Start a query that lands its rows, a folder per batch.

    A batch that is repeated after a failure overwrites its own folder; a restart resumes. It
    lands what is available and stops or, with ``every``, goes on at that interval. State that
    is forgotten by time needs a query that goes on: it never runs out of batches. A
    ``progress.UniqueProgress`` added to the session's listeners reports keys as they arrive.
    """
    if keep_ms is not None and every is None:
        raise ValueError("keep_ms needs a query that goes on: give the interval of its batches")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    with stateful(rows.sparkSession):
        passed = observed(first_arrivals_so_far(rows, key, order_by, keep_ms), F.col(REVISION) == 0)
        return (
            passed.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint).outputMode("update").trigger(**trigger).start()
        )
