"""Product codes of vectors, exact in integers, by a Walsh-Hadamard transform.

Every component becomes an integer (``floor(scale * x)``) and a vector is cut
into ``parts`` equal consecutive parts. Each part position has a codebook whose
entries start as that part of the first vectors by id; ``rounds`` times every
part goes to its nearest entry and every entry becomes the floored mean of its
parts. Only sums and counts of the entries reach the driver: parts * entries *
(part length + 1) numbers, whatever the table's size.

*Nearest entry.* Parts and entries are zero-padded to a power of two, m, and
transformed by the integer Walsh-Hadamard matrix. It is orthogonal up to a
factor, so the squared differences of the transforms sum to m times the squared
distance. They are added in sequency order (rows of few sign changes first).
After the first half of them (three of four in parts of four) the entry that
leads is measured in full; any other whose sum passes that bound is out and its
remaining coefficients are never computed. Sums only grow, so no nearest entry
is lost, ties included.

*Exactness.* No floating point after the flooring. Blocks whose sums provably
fit 64 bits use int64; others (components past some 2^27) use Python integers.
Sums travel in limbs of 48 bits and are added as decimals.

Defined cases: vectors that are null or hold null or non-finite components are
dropped; an empty table, or one of dropped rows only, gives no rows; with fewer
vectors than ``entries`` there are so many entries; null ids come last, equal ids
are ordered by their vectors; repeated rows are coded each; vectors are
zero-padded to the longest one's length, and that to a multiple of ``parts``; an
error that does not fit a long is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clientlens.llm.shared import small_batches, written

_LIMB = 48
_LONG = 1 << 63


@dataclass(frozen=True)
class Codebooks:
    """``entries``: by part, entry and position, Python integers."""
    entries: list
    width: int
    scale: int

    def digest(self) -> str:
        flat = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()


def sequency_hadamard(m: int) -> np.ndarray:
    """The m x m matrix of +1 and -1, rows by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < m:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(1), kind="stable")]


def number_type(largest: int, m: int):
    """The narrowest type in which transforms and scaled distances of parts of
    m components up to ``largest`` in magnitude are exact."""
    most = 4 * m ** 3 * largest * largest
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 62 else object


def integer_block(vectors: pa.Array, scale: int, dim: int) -> np.ndarray:
    """(rows, dim) of floor(scale * x), zero-padded: int64, or Python integers
    where a component is too large for that. Doubles past 2^52 are whole."""
    size = vectors.value_lengths().to_numpy()
    flat = np.zeros((len(vectors), dim))
    flat[np.arange(dim) < size[:, None]] = vectors.flatten().to_numpy()
    if not flat.size or np.abs(flat).max() * scale < 1 << 52:
        return np.floor(flat * scale).astype(np.int64)
    exact = [[math.floor(x * scale) if abs(x) * scale < 1 << 52 else _floor_product(x, scale) for x in row] for row in flat.tolist()]
    return np.array(exact, object).reshape(flat.shape)


def _floor_product(x: float, scale: int) -> int:
    a, b = x.as_integer_ratio()
    return a * scale // b


def nearest_entries(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x (rows, parts, width) and books (parts, entries, width), both integer:
    (index of the nearest entry, squared distance), each (rows, parts)."""
    m = 1 << max(0, x.shape[2] - 1).bit_length()
    largest = max((max(abs(int(a.min())), abs(int(a.max()))) for a in (x, books) if a.size), default=0)
    kind = number_type(largest, m)
    h = sequency_hadamard(m)[:, :x.shape[2]].astype(kind)
    tx = np.ascontiguousarray(np.moveaxis(x.astype(kind) @ h.T, 2, 0))
    tb = np.ascontiguousarray(np.moveaxis(books.astype(kind) @ h.T, 2, 0))  # (m, parts, entries)
    step = 128  # rows whose differences fit a core's cache
    found = [_nearest(tx[:, i:i + step], tb) for i in range(0, max(1, x.shape[0]), step)]
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _nearest(tx: np.ndarray, tb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """nearest_entries on transforms (m, rows, parts) and (m, parts, entries)."""
    m, rows, parts = tx.shape
    entries = tb.shape[2]
    tx = tx.reshape(m, rows * parts)
    part = np.tile(np.arange(parts), rows)

    total = np.zeros((rows, parts, entries), tx.dtype)
    early = max(1, m // 2, min(3, m - 1))  # whole arrays so far: cheaper than gathering survivors
    for c in range(early):
        d = tx[c].reshape(rows, parts, 1) - tb[c]
        total += d * d
    total = total.reshape(rows * parts, entries)
    at = np.arange(rows * parts)
    lead = total.argmin(1)
    bound = total[at, lead]
    for c in range(early, m):
        d = tx[c] - tb[c, part, lead]
        bound = bound + d * d
    left = np.flatnonzero((total <= bound[:, None]).astype(bool))
    who, entry, total = left // entries, left % entries, total.ravel()[left]
    for c in range(early, m):
        d = tx[c, who] - tb[c, part[who], entry]
        total = total + d * d
        if c + 1 < m:
            stay = (total <= bound[who]).astype(bool)
            who, entry, total = who[stay], entry[stay], total[stay]
    # of each row's survivors, in order of their index, the first that is least
    first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])[:len(who)])
    least = np.minimum.reduceat(total, first) if len(first) else total[:0]
    hit = (total == np.repeat(least, np.diff(np.append(first, len(who))))).astype(bool)
    hit = np.flatnonzero(hit)
    hit = hit[np.concatenate([[True], who[hit][1:] != who[hit][:-1]])[:len(hit)]]
    least = least if least.dtype == object else least.astype(np.int64)
    return entry[hit].reshape(rows, parts), (least // m).reshape(rows, parts)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(number, limb) with value = sum of limb * 2^(48 * number); the last
    limb carries the sign."""
    i = 0
    while not -(1 << 62) < value < 1 << 62:
        yield i, value & ((1 << _LIMB) - 1)
        value >>= _LIMB
        i += 1
    yield i, value


def _blocks(batches, scale: int, parts: int, width: int):
    for b in batches:
        for start in range(0, b.num_rows, 2048):
            t = b.slice(start, 2048)
            x = integer_block(t.column("v"), scale, parts * width)
            yield t, x.reshape(len(x), parts, width)


def _sums(books: Codebooks, parts: int):
    """Partial sums of a task: (slot, limb, value); slots count positions
    within entries within parts, the last position being the count."""
    def run(batches):
        table, width = np.array(books.entries, object), books.width
        entries = table.shape[1]
        total = np.zeros((parts * entries, width + 1), object)
        table = _narrow(table)
        for _, x in _blocks(batches, books.scale, parts, width):
            code, _ = nearest_entries(x, table)
            slot = (np.arange(parts) * entries + code).ravel()
            order = np.argsort(slot, kind="stable")
            slot, flat = slot[order], x.reshape(-1, width)[order]
            lead = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])[:len(slot)])
            if not len(lead):
                continue
            total[slot[lead], :width] += np.add.reduceat(flat, lead, axis=0).astype(object)
            total[slot[lead], width] += np.diff(np.append(lead, len(slot))).astype(object)
        rows = [(s * (width + 1) + i, n, v) for s in np.flatnonzero(total[:, width]).tolist()
                for i in range(width + 1) for n, v in limbs(int(total[s, i]))]
        if rows:
            a, b, c = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.int64())],
                                             names=["slot", "limb", "value"])
    return run


def _narrow(a: np.ndarray) -> np.ndarray:
    """int64 if every element fits."""
    return a.astype(np.int64) if all(-_LONG <= x < _LONG for x in a.ravel().tolist()) else a


def _codes(books: Codebooks, parts: int):
    def run(batches):
        table = _narrow(np.array(books.entries, object))
        for t, x in _blocks(batches, books.scale, parts, books.width):
            code, error = nearest_entries(x, table)
            sums = [sum(e) for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [t.column("id"), t.column("label"), pa.array([bytes(c).hex() for c in code.astype(np.uint8).tolist()], pa.string()),
                 pa.array([e if e < _LONG else None for e in sums], pa.int64())], names=["id", "label", "code", "error"])
    return run


def _kept(df: DataFrame, vec_id: str, vector: str, label: str | None) -> DataFrame:
    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    kind = F.col(label) if label else F.lit(None).cast("string")
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    return df.select(F.col(vec_id).alias("id"), kind.alias("label"), v.alias("v")).filter(F.col("v").isNotNull() & F.forall("v", usable))


def fit_codebooks(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64,
                  rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks of ``df``'s vectors, or None if it has no usable one. One
    job for the length, one for the first entries, one for every round."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for the entry: 1 to 256 entries")
    small_batches(df.sparkSession, 8192)
    rows = _kept(df, vec_id, vector, None)
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return None
    width = -(-dim // parts)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = integer_block(pa.array([r.v for r in first], pa.list_(pa.float64())), scale, parts * width).reshape(len(first), parts, width)
    books = Codebooks([[[int(c) for c in e] for e in start[:, p]] for p in range(parts)], width, scale)
    for _ in range(rounds):
        partial = rows.select("v").mapInArrow(_sums(books, parts), "slot long, limb int, value long")
        total: dict[int, int] = {}
        for r in partial.groupBy("slot", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect():
            total[r.slot] = total.get(r.slot, 0) + (int(r.s) << (_LIMB * r.limb))
        size = width + 1

        def moved(slot: int, old: list) -> list:
            n = total.get(slot * size + width, 0)
            return [total[slot * size + i] // n for i in range(width)] if n else old
        books = Codebooks([[moved(p * len(first) + e, books.entries[p][e]) for e in range(len(first))] for p in range(parts)],
                          width, scale)
    return books


def encode(df: DataFrame, books: Codebooks, vec_id: str = "vec_id", vector: str = "embedding",
           label: str = "label") -> DataFrame:
    """id, label, code (two hex digits for every part's entry), error (squared
    distance to the coded vector) and label_error (its sum over the label; null
    labels are one) of every usable row."""
    small_batches(df.sparkSession, 8192)
    rows = _kept(df, vec_id, vector, label)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    coded = written(rows.mapInArrow(_codes(books, len(books.entries)), f"id {kinds['id']}, label {kinds['label']}, code string, error long"),
                    "vector-codes")
    sums = coded.groupBy(F.col("label").alias("l")).agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("l")), "left").drop("l")


def vector_codes(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", **options) -> DataFrame:
    """fit_codebooks and encode, with the codebooks' digest in every row."""
    books = fit_codebooks(df, vec_id, vector, **options)
    if books is None:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        return df.sparkSession.createDataFrame([], f"id {kinds[vec_id]}, label {kinds[label]}, code string, error long, "
                                                   "label_error long, codebooks_sha256 string")
    return encode(df, books, vec_id, vector, label).withColumn("codebooks_sha256", F.lit(books.digest()))
