"""Purchases as a stream: re-sent rows counted once, and the previous category
of every purchase.

Both need a watermark on the purchase time. A purchase at or before the
watermark is late: ``dedupe_stream`` drops it, and so does
``transitions_stream``, whose pairs of that time are already out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from clientlens.roles import Roles

#: keyed state with timers lives in this store (a session setting)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ---------------------------------------------------------------- duplicates
def _least_of_each(keys: list[str], order: list[str]):
    """One row of each key within a task's part of a micro-batch: the first in
    ``order``, nulls last. Holds that part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.take(t.select(order).to_pandas().assign(_at=range(t.num_rows)).sort_values(
            [*order, "_at"], kind="stable", na_position="last")["_at"].to_numpy())
        first = ~t.select(keys).to_pandas().duplicated().to_numpy()
        yield from t.filter(pa.array(first)).combine_chunks().to_batches()
    return run


def dedupe_stream(stream: DataFrame, key: str | Sequence[str], ts: str, order: Sequence[str] | None = None,
                  watermark: str = "1 day") -> DataFrame:
    """One row per key, however often it is sent again within ``watermark``.

    The winner is the row of the earliest micro-batch; of several rows of a key
    in one micro-batch, the first by ``order`` (default: ``ts``, then every other
    column of a simple type; ascending, nulls last). Rows meet on one exchange by
    key, where each task keeps the first row of every key of its part of the
    micro-batch; the state then holds one entry per key until the watermark
    passes it, so it is bounded by the keys of ``watermark``'s span, and
    survives a restart with the query's checkpoint."""
    keys = [key] if isinstance(key, str) else list(key)
    simple = [f.name for f in stream.schema.fields if f.name not in (ts, *keys) and not f.dataType.simpleString().startswith(("array", "map", "struct"))]
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    schema = rows.schema
    rows = rows.repartition(*keys).mapInArrow(_least_of_each(keys, list(order or [ts, *simple])), schema)
    return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


# ---------------------------------------------------------------- transitions
#: purchases of a client in one packed row, at most
_PACK = 10_000
#: rows of a task's part of a micro-batch that are packed at a time
_HELD = 1 << 20


def _texts(rows: Sequence[tuple]) -> list[str]:
    """(time, id, category) rows as packed texts: three lists each."""
    return [json.dumps([*zip(*rows[s:s + _PACK])], separators=(",", ":")) for s in range(0, len(rows), _PACK)]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, last, first, rows): a client's purchases, packed, with their last and
    first time in microseconds."""
    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        who = t.column("c").combine_chunks().dictionary_encode()
        code = who.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        code, at = code[order], t.column("t").to_numpy()[order]
        rest = t.select(["i", "k"]).take(pa.array(order))
        times, ids, kinds = at.tolist(), rest.column("i").to_pylist(), rest.column("k").to_pylist()
        cut = np.flatnonzero(np.diff(code, prepend=-1))
        cut = np.concatenate([np.arange(s, e, _PACK) for s, e in zip(cut, [*cut[1:], len(code)])])
        rows = [json.dumps([times[s:e], ids[s:e], kinds[s:e]], separators=(",", ":")) for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(code)])]
        return pa.RecordBatch.from_arrays([who.dictionary.take(pa.array(code[cut])), pa.array(np.maximum.reduceat(at, cut)),
                                           pa.array(np.minimum.reduceat(at, cut)), pa.array(rows)], names=["c", "last", "first", "rows"])

    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held, n = [*held, b], n + b.num_rows
        if n >= _HELD:
            yield packed(held)
            held, n = [], 0
    if held:
        yield packed(held)


class _Transitions(StatefulProcessor):
    """Per client one list: the category of the last closed purchase, and the
    packed purchases that the watermark has not passed yet."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "last string, rows string")

    def handleInputRows(self, key, rows, timerValues):
        passed = timerValues.getCurrentWatermarkInMs()
        new, first = [], []
        for r in rows:
            if r["first"] // 1000 > passed:
                new.append((None, r["rows"]))
                first.append(r["first"])
            elif left := [z for z in zip(*json.loads(r["rows"])) if z[0] // 1000 > passed]:    # the others are late
                new += [(None, x) for x in _texts(left)]
                first.append(min(z[0] for z in left))
        if new:
            self.open.appendList(new)
            self.handle.registerTimer(min(first) // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        kept = list(self.open.get())
        held = [z for _, rows in kept for z in zip(*json.loads(rows))]
        done = sorted((z for z in held if z[0] // 1000 <= passed), key=lambda z: (z[0], z[1] is not None, 0 if z[1] is None else z[1]))
        if not done:    # another timer of the client has closed them
            return
        left = [z for z in held if z[0] // 1000 > passed]
        prev = [kept[0][0], *(k for _, _, k in done)]
        if left or prev[-1] is not None:
            self.open.put([(prev[-1], x) for x in _texts(left) or ["[]"]])
        else:
            self.open.clear()
        if left:
            self.handle.registerTimer(min(z[0] for z in left) // 1000)
        out = [(t, i, p, k) for (t, i, k), p in zip(done, prev) if p is not None]
        for s in range(0, len(out), _PACK):
            t, i, p, k = zip(*out[s:s + _PACK])
            yield Row(c=key[0], rows=json.dumps({"t": t, "i": i, "prev": p, "k": k}))

    def close(self) -> None:
        pass


def transitions_stream(stream: DataFrame, r: Roles, watermark: str = "1 hour", prev_name: str = "categorie_precedente") -> DataFrame:
    """client, time, id, previous category, category of every purchase whose
    client has an earlier one with a category; the streaming form of the ``lag``
    behind ``category_transitions``. Append mode; the session's state store must
    be ``STATE_STORE``.

    A purchase is put out once the watermark has passed it, with those of its
    client in order (time, id), whatever order they came in. So the pairs of
    closed time are those of the batch operator, over any number of restarts,
    as long as no row is late. Rows without a client or a time are dropped. State: one
    category per client, and the purchases of the watermark's span. A client's
    purchases of a micro-batch enter the state, and its pairs leave it, as packed
    texts, so that no single row passes between Spark and the processor."""
    kind = stream.schema[r.id].dataType
    id_type = "bigint" if isinstance(kind, IntegralType) else "string"
    client = stream.schema[r.client].dataType.simpleString()
    rows = stream.select(F.col(r.client).alias("c"), F.unix_micros(F.col(r.ts).cast("timestamp")).alias("t"), F.col(r.id).cast(id_type).alias("i"),
                         F.col(r.category).cast("string").alias("k")).where("c is not null and t is not null")
    # the watermark follows the latest time of each packed row, so of all rows
    packed = rows.repartition("c").mapInArrow(_pack, f"c {client}, last bigint, first bigint, rows string") \
        .select("c", F.timestamp_micros("last").alias("ts"), "first", "rows").withWatermark("ts", watermark)
    pairs = packed.groupBy("c").transformWithState(_Transitions(), outputStructType=f"c {client}, rows string", outputMode="append", timeMode="EventTime")
    pairs = pairs.select("c", F.from_json("rows", f"t array<bigint>, i array<{id_type}>, prev array<string>, k array<string>").alias("p")) \
        .select("c", F.inline(F.arrays_zip("p.t", "p.i", "p.prev", "p.k")).alias("t", "i", "prev", "k"))
    return pairs.select(F.col("c").alias(r.client), F.timestamp_micros("t").alias(r.ts), F.col("i").alias(r.id),
                        F.col("prev").alias(prev_name), F.col("k").alias(r.category))


def transition_counts(pairs: DataFrame, r: Roles, prev_name: str = "categorie_precedente") -> DataFrame:
    """Counts of the pairs that a stream has put out, as ``category_transitions``
    gives them."""
    return pairs.groupBy(prev_name, r.category).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc_nulls_first(prev_name), F.asc_nulls_first(r.category))
