"""Best-fit packing of tokenised documents, in bulk-synchronous rounds.

Documents become token ids with an end id behind them; only those longer than a
sequence are cut, into pieces of ``capacity`` (the first piece takes the rest,
so that it packs like any other). Full pieces are sequences of their own.

*Rounds.* Every piece above half the capacity opens a sequence, since no two of
them fit together. Then, in rounds, pieces and gaps are range-sorted together by
size and swept upwards: a gap takes the largest piece still unmatched at or
below its size, which is best fit for all gaps at once. A gap of at least twice
the largest piece's size is offered as several equal slots. A sweep runs in one
task per range; matches between ranges follow from the ranges' counts alone: of
a range's unmatched gaps the i-th meets the i-th last unmatched piece of the
ranges before it, so conflicts are resolved by rank, and the two ends meet in a
join on that number. Gaps shrink by what they took, and the next round begins.
When a round places nothing, no piece fits any gap; the largest pieces open as
many sequences as the remaining tokens need at least.

Every round takes a maximal matching, and a stall leaves geometrically fewer
pieces: some 5 to 15 rounds, whatever the number of pieces. The driver sees
counts by size (at most ``capacity``) and by range. Rounds are tables in the
shared folder.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; any id, null too, may be packed; an empty table gives no rows;
text that reads like a special token is encoded as that token, as the
``tokenizers`` library does by default. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from clientlens.llm.shared import small_batches, written

_encoders: dict[str, object] = {}


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file of ``tokenizers``. Where merges
    stand in the order of their ids, ``tiktoken`` gives the same ids several
    times faster; texts that its pattern matcher gives up on (very long runs of
    white space) and other vocabularies go to ``tokenizers``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.exact, self.fast = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        vocabulary = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        pre, merges = spec.get("pre_tokenizer") or {}, spec["model"].get("merges") or []
        merges = [m if isinstance(m, str) else " ".join(m) for m in merges]
        ordered = [vocabulary.get(m.replace(" ", "")) for m in merges]
        if pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and spec.get("normalizer") is None \
                and ordered == list(range(256, 256 + len(merges))) and len(vocabulary) == 256 + len(merges):
            import tiktoken
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, special_tokens=special,
                                          mergeable_ranks={bytes(byte[c] for c in w): i for w, i in vocabulary.items()})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> Encoder:
    """One per process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n > 0 tokens."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(vocabulary: str, capacity: int, end_id: int):
    def run(batches):
        enc, base, made = encoder(vocabulary), TaskContext.get().partitionId() << 36, 0
        for b in batches:
            row, rows = [], []
            for i, t in enumerate(b.column("t")):
                ids = np.append(enc.ids(t.as_py() or ""), end_id).astype("<u4")
                for p, (start, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    rows.append((p, start, n, zlib.crc32(ids[start:start + n].tobytes()), base + made))
                    made += 1
            piece, start, n, crc, uid = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(n),
                 pa.array(crc), pa.array(uid)], names=["doc_id", "piece", "start", "length", "ids_crc32", "uid"])
    return run


def token_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
                 end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and a unique number, uid, of
    every piece. ``vocabulary`` is a file that every executor has."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(_pieces(vocabulary, capacity, end_id),
                                   f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, uid long"), "pieces")


def matched(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items in order of size, pieces (False) before gaps (True) of the same
    size. Every gap takes the nearest unmatched piece before it. Places of
    (matched pieces, their gaps, unmatched pieces, unmatched gaps)."""
    depth = np.cumsum(np.where(is_gap, -1, 1))
    level = depth + is_gap  # a piece and its gap are neighbours on one level
    order = np.argsort(level, kind="stable")
    lv, gap = level[order], is_gap[order]
    pair = np.flatnonzero((lv[1:] == lv[:-1]) & ~gap[:-1] & gap[1:]) if len(order) > 1 else np.zeros(0, np.int64)
    piece, its = order[pair], order[pair + 1]
    free = np.ones(len(is_gap), bool)
    free[piece] = free[its] = False
    return piece, its, np.flatnonzero(free & ~is_gap), np.flatnonzero(free & is_gap)


def _sweep(batches):
    """One range in order (size, gap, id) -> rows (what, uid, seq, size, part,
    rank): 0 a match, 1 an unmatched piece, 2 an unmatched gap. Holds one batch
    and the unmatched pieces so far."""
    part = TaskContext.get().partitionId()
    stack: list[tuple[np.ndarray, np.ndarray]] = []
    gaps = 0

    def out(what, uid, seq, size, rank):
        n = len(size)
        full = lambda x, t: pa.array(np.full(n, x, t)) if np.isscalar(x) else pa.array(x.astype(t))
        return pa.RecordBatch.from_arrays([full(what, np.int32), full(uid, np.int64), full(seq, np.int64), full(size, np.int32),
                                           full(part, np.int32), full(rank, np.int64)],
                                          names=["what", "uid", "seq", "size", "part", "rank"])

    for b in batches:
        ids, size, is_gap = b.column("id").to_numpy(), b.column("size").to_numpy(), b.column("gap").to_numpy(zero_copy_only=False)
        piece, its, free, open_ = matched(is_gap)
        if len(piece):
            yield out(0, ids[piece], ids[its], size[piece], -1)
        while len(open_) and stack:
            uid, sizes = stack.pop()
            n = min(len(uid), len(open_))
            yield out(0, uid[::-1][:n], ids[open_[:n]], sizes[::-1][:n], -1)
            open_ = open_[n:]
            if n < len(uid):
                stack.append((uid[:len(uid) - n], sizes[:len(uid) - n]))
        if len(open_):
            yield out(2, -1, ids[open_], size[open_], np.arange(gaps, gaps + len(open_)))
            gaps += len(open_)
        if len(free):
            stack.append((ids[free], size[free]))
    rank = 0
    for uid, sizes in stack:
        yield out(1, uid, -1, sizes, np.arange(rank, rank + len(uid)))
        rank += len(uid)


def between_ranges(counts: dict[int, tuple[int, int]]) -> tuple[list, list]:
    """Unmatched (pieces, gaps) by range -> runs (range, first rank, last rank,
    first match number) of pieces, whose numbers fall by rank, and of gaps,
    whose numbers rise. The n-th piece and gap match."""
    stack, pieces, gaps, number = [], [], [], 0
    for part in sorted(counts):
        n_pieces, n_gaps = counts[part]
        done = 0
        while done < n_gaps and stack:
            q, n = stack.pop()
            t = min(n, n_gaps - done)
            pieces.append((q, n - t, n - 1, number))
            gaps.append((part, done, done + t - 1, number))
            number += t
            done += t
            if t < n:
                stack.append((q, n - t))
        if n_pieces:
            stack.append((part, n_pieces))
    return pieces, gaps


def _numbered(pieces: list, gaps: list):
    """Adds the match number (null: none) to unmatched pieces and gaps."""
    runs = []
    for table in (pieces, gaps):
        table = np.array(sorted(table), np.int64).reshape(-1, 4)
        runs.append((table[:, 0] << 40 | table[:, 1], table))

    def run(batches):
        for b in batches:
            what, part, rank = (b.column(c).to_numpy() for c in ("what", "part", "rank"))
            number = np.full(len(what), -1, np.int64)
            for kind, (key, table) in zip((1, 2), runs):
                mine = np.flatnonzero(what == kind)
                if not len(mine) or not len(key):
                    continue
                p, r = part[mine].astype(np.int64), rank[mine]
                t = table[np.maximum(np.searchsorted(key, p << 40 | r, side="right") - 1, 0)]
                ok = (t[:, 0] == p) & (t[:, 1] <= r) & (r <= t[:, 2])
                number[mine] = np.where(ok, t[:, 3] + np.where(kind == 1, t[:, 2] - r, r - t[:, 1]), -1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("what", "uid", "seq", "size")), pa.array(number, mask=number < 0)],
                                             names=["what", "uid", "seq", "size", "number"])
    return run


def _match(todo: DataFrame, gaps: DataFrame, least: int, most: int) -> tuple[DataFrame | None, DataFrame]:
    """One round: (placed pieces uid, seq, size; pieces left), or (None, todo)
    if nothing fits."""
    slots = F.greatest(F.lit(1), F.floor(F.col("room") / most).cast("int"))
    offered = gaps.filter(F.col("room") >= least).withColumn("k", slots) \
        .select(F.floor(F.col("room") / F.col("k")).cast("int").alias("size"), F.lit(True).alias("gap"), F.col("seq").alias("id"),
                F.explode(F.sequence(F.lit(1), "k")).alias("slot")).drop("slot")
    items = todo.select("size", F.lit(False).alias("gap"), F.col("uid").alias("id")).unionByName(offered)
    order = ("size", "gap", "id")
    swept = written(items.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(_sweep, "what int, uid long, seq long, size int, part int, rank long"), "packing-swept")
    counts: dict[int, list[int]] = {}
    found = 0
    for r in swept.groupBy("part", "what").agg(F.count(F.lit(1)).alias("n")).collect():
        if r.what:
            counts.setdefault(r.part, [0, 0])[r.what - 1] = r.n
        else:
            found += r.n
    pieces, free = between_ranges(counts)
    placed = swept.filter("what = 0").select("uid", "seq", "size")
    left = swept.filter("what = 1")
    if pieces:
        left = written(swept.filter("what > 0").mapInArrow(_numbered(pieces, free), "what int, uid long, seq long, size int, number long"),
                       "packing-numbered")
        ends = left.filter("what = 2 and number is not null").select(F.col("seq").alias("s"), F.col("number").alias("n"))
        placed = placed.unionByName(left.filter("what = 1 and number is not null").join(ends, F.col("number") == F.col("n"))
                                    .select("uid", F.col("s").alias("seq"), "size"))
        left = left.filter("what = 1 and number is null")
    elif not found:
        return None, todo
    return written(placed, "packing-placed"), left.select("uid", "size")


def _largest(todo: DataFrame, n: int):
    """Condition that holds for about the ``n`` largest pieces: of the last
    size so many of 4,096 hash buckets as are needed."""
    sizes = sorted(((r["size"], r["count"]) for r in todo.groupBy("size").count().collect()), reverse=True)
    for size, count in sizes:
        if count >= n:
            break
        n -= count
    bucket = F.pmod(F.xxhash64("uid"), F.lit(4096))
    for last, count in sorted((r["b"], r["count"]) for r in todo.filter(F.col("size") == size).groupBy(bucket.alias("b")).count().collect()):
        n -= count
        if n <= 0:
            break
    return (F.col("size") > size) | ((F.col("size") == size) & (bucket <= last))


def pack_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (unique uid, length from 1 to ``capacity``) -> uid,
    sequence_id, offset. A sequence is named by the piece that opened it."""
    parts: list[DataFrame] = []

    def opened(df: DataFrame) -> DataFrame:
        parts.append(df.select("uid", F.col("uid").alias("seq"), "size"))
        return df.select(F.col("uid").alias("seq"), (F.lit(capacity) - F.col("size")).alias("room"))

    todo = pieces.filter(F.col("length") < capacity).select("uid", F.col("length").cast("int").alias("size"))
    gaps = opened(todo.filter(2 * F.col("size") > capacity))
    todo = todo.filter(2 * F.col("size") <= capacity)
    while True:
        s = todo.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"), F.min("size").alias("least"), F.max("size").alias("most")).first()
        if not s.n:
            break
        placed, todo = _match(todo, gaps, s.least, s.most)
        if placed is None:
            pick = _largest(todo, -(-s.tokens // capacity))
            gaps = written(gaps.filter(F.col("room") >= s.least).unionByName(opened(todo.filter(pick))), "packing-gaps")
            todo = todo.filter(~pick)
        else:
            parts.append(placed)
            used = placed.groupBy("seq").agg(F.sum("size").cast("int").alias("used"))
            gaps = gaps.filter(F.col("room") >= s.least).join(used, "seq", "left") \
                .select("seq", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")).filter("room > 0")
            gaps = written(gaps, "packing-gaps")
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("step", F.lit(i))
        every = p if every is None else every.unionByName(p)
    before = W.partitionBy("seq").orderBy("step", "uid").rowsBetween(W.unboundedPreceding, -1)
    packed = every.select("uid", F.col("seq").alias("sequence_id"), F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset"))
    full = pieces.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
         end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every
    piece; the offsets of a sequence are gapless from 0."""
    pieces = token_pieces(docs, vocabulary, doc_id, text, capacity, end_id)
    return pieces.join(pack_pieces(pieces, capacity), "uid") \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
