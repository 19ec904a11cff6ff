"""Parity-sketch similarity join on word shingles.

A document is its set of distinct shingles (64-bit hashes, five words). Two
link if 100 * |A & B| >= 100 * least * |A | B|, hence |A ^ B| <= (|A| + |B|) / 7
at 0.75.

*Classes.* Equal sets are one node, keyed by a hash of the set; copies are
counted and never expanded into pairs.

*Parity sketches.* A part of the hash space holds the XOR of the hashes that
fall into it: 64 parity bits a part. One differing shingle changes one part,
so the number of differing parts (and the Hamming distance of a 512-bit parity
sketch, one bit flipped a shingle) is a lower bound of |A ^ B|.

*Pigeonhole join.* Sizes are cut into bands (1-63, 64-255, 256-1023, ...);
all sets of a band are cut into the same parts. If A and B link, at most
D = floor(size / 3) of a set's non-empty parts differ, so under any common order
of the parts' values the first D + 1 of both sets share one. Only those are
joined. A set that can link into the band below is put there, too. Parts are
numerous enough that a set has more than D non-empty ones (the chance of the
contrary is below 1e-10 a set). The order puts values made of common shingles
(lines and passages that many texts share) last, so they rarely lead a join.

*Verification.* Candidate pairs whose size ratio or Hamming distance (of 512-bit
sketches, then of sketches with two or more bits a shingle) rules a link out are dropped; the rest are intersected exactly, on the sets
computed again from the whole texts of the rows concerned, but for pairs whose
ends earlier links have already joined.

*Large groups.* A joined value shared by more than ``group`` nodes is not
expanded into pairs: all its members meet the member with the fewest uncommon
parts, components are formed, and only members outside the group's largest
component meet the others, in blocks of bounded size inside tasks which put out
just the pairs that the sketches can't rule out. No link is lost; only pairs
already connected are skipped.

Defined cases: a null text or one without words has no shingles and links with
nothing; null ids join their class but never name a component; repeated rows
are one class; rows of one id with different texts are judged by text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clientlens.llm.components import connected_components
from clientlens.llm.shared import small_batches, temp_name, text_blocks, written
from clientlens.llm.shingles import mix, order_within, shingle_sets

BITS = 512
_LONGS = [f"s{i}" for i in range(BITS // 64)]
GROUP, BLOCK = 16, 2048


def set_keys(h: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """One 64-bit key per set, from the sum and the XOR of its mixed hashes."""
    n = np.bincount(owner, minlength=texts)
    first = np.cumsum(n) - n
    out = np.zeros(texts, np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        m = mix(h + np.uint64(0x632BE59BD9B4E019))
        total, parity = np.add.reduceat(m, first[full]), np.bitwise_xor.reduceat(h, first[full])
        out[full] = mix(total ^ mix(parity) ^ n[full].astype(np.uint64))
    return out


def bit_sketches(h: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, BITS / 64): every shingle flips one of BITS bits."""
    bit = (mix(h) >> np.uint64(64 - 9)).astype(np.int64)
    odd = (np.bincount(owner * BITS + bit, minlength=texts * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, BITS), axis=1, bitorder="little").view(np.uint64)


def wide_sketches(h: np.ndarray, owner: np.ndarray, texts: int) -> pa.Array:
    """One parity sketch per text of twice its size or more bits (a power of
    2), as bytes. Folding a sketch in half by XOR gives the next smaller one."""
    n = np.bincount(owner, minlength=texts)
    bits = 1 << np.ceil(np.log2(np.maximum(2 * n, BITS))).astype(np.int64)
    first = np.cumsum(bits) - bits
    at = first[owner] + (mix(h) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    data = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little")
    ends = np.concatenate([[0], np.cumsum(bits // 8)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def sketch_distance(x: bytes, y: bytes) -> int:
    """Hamming distance after folding the longer sketch to the other's size."""
    a, b = (np.frombuffer(z, np.uint8) for z in (x, y))
    if len(a) < len(b):
        a, b = b, a
    a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def wide_distances(wide: pa.Array, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """sketch_distance of the pairs of rows x[k], y[k], a block of pairs of
    equally long sketches at a time."""
    ends = np.frombuffer(wide.buffers()[1], np.int32)[wide.offset:wide.offset + len(wide) + 1].astype(np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8)
    size = np.diff(ends)
    swap = size[x] < size[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    out = np.zeros(len(x), np.int64)
    shape = size[x] * (1 << 32) + size[y]
    for key in np.unique(shape):
        at = np.flatnonzero(shape == key)
        nx, ny = int(key) >> 32, int(key) & 0xFFFFFFFF
        step = max(1, 8_000_000 // nx)
        for s in range(0, len(at), step):
            k = at[s:s + step]
            a = data[ends[x[k]][:, None] + np.arange(nx)].reshape(len(k), -1, ny)
            b = data[ends[y[k]][:, None] + np.arange(ny)]
            out[k] = np.bitwise_count(np.bitwise_xor.reduce(a, axis=1) ^ b).sum(1, dtype=np.int64)
    return out


def band_of(n: np.ndarray) -> np.ndarray:
    """0 for sizes under 64, then one band for each power of 4."""
    return np.where(n < 64, 0, np.floor(np.log2(np.maximum(n, 1)) / 2 + 1e-9).astype(np.int64) - 2)


def band_top(band: np.ndarray) -> np.ndarray:
    """The largest size of a band."""
    return 4 ** (np.asarray(band, np.int64) + 3) - 1


def parts_of(band: np.ndarray) -> np.ndarray:
    """How many parts a band's sets are cut into (a power of 2)."""
    return np.where(band == 0, 1 << 16, 2 * 4 ** (np.maximum(band, 1) + 2))


def lead_values(h: np.ndarray, owner: np.ndarray, band: np.ndarray, most: np.ndarray, usual: np.ndarray):
    """Leading part values of sets put into ``band`` (one band a set): the
    first ``most[set]`` under the common order. ``h`` is sorted within each
    owner, so that a part (the hash's leading bits) is a run; ``usual`` marks
    common shingles. Returns (value, set, uncommon parts of the set) rows."""
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.log2(parts_of(band)).astype(np.uint64)
    part = h >> (np.uint64(64) - bits[owner])
    lead = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])]))
    value = np.bitwise_xor.reduceat(h, lead)
    who, part = owner[lead], part[lead]
    value = mix(value ^ mix(part * np.uint64(64) + band[who].astype(np.uint64)))
    late = np.logical_and.reduceat(usual, lead)  # made of common shingles only
    uncommon = np.bincount(who, ~late, minlength=len(band)).astype(np.int64)
    order = order_within(who, (late.astype(np.uint64) << np.uint64(63)) | (value >> np.uint64(1)))
    value, who = value[order], who[order]
    n = np.bincount(who, minlength=len(band))
    rank = np.arange(len(who)) - (np.cumsum(n) - n)[who]
    keep = rank < most[who]
    return value[keep], who[keep], uncommon[who[keep]]


def is_common(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(h), bool)
    return common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h


def _sketch(words: int):
    def run(batches):
        seen: Counter[int] = Counter()
        for b in batches:
            texts = b.column("t").to_pylist()
            for start, part in text_blocks(texts):
                h, owner = shingle_sets(part, words)
                k = len(part)
                n = np.bincount(owner, minlength=k)
                u, c = np.unique(h, return_counts=True)
                seen.update(dict(zip(u[c > 1].tolist(), c[c > 1].tolist())))
                bits = bit_sketches(h, owner, k).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(start, k), b.column("tx").slice(start, k), pa.array(n),
                     pa.array(set_keys(h, owner, k).view(np.int64), mask=n == 0),
                     *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(BITS // 64)),
                     wide_sketches(h, owner, k), pa.nulls(k, pa.int64())],
                    names=["doc_id", "tx", "n", "node", *_LONGS, "wide", "common"])
        # shingles that several texts of a block share, with their counts
        hot = [(x, c) for x, c in seen.items() if c >= 4]
        if hot:
            x = np.array([x for x, _ in hot], np.uint64).view(np.int64)
            none = pa.nulls(len(hot), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array([c for _, c in hot], pa.int64()), none, *([none] * len(_LONGS)),
                 pa.nulls(len(hot), pa.binary()), pa.array(x)],
                names=["doc_id", "tx", "n", "node", *_LONGS, "wide", "common"])
    return run


def _leads(words: int, least: float, held):
    """Rows (value, node, weight): weight packs the count of uncommon parts
    and the size, so that a group's first row is its best hub."""
    third = (1 - least) / least  # |A ^ B| <= third * |A| for linked A, B

    def run(batches):
        common, done = held.value, set()
        for b in batches:
            for _, part in text_blocks(b.column("t").to_pylist()):
                h, owner = shingle_sets(part, words)
                k = len(part)
                n, key = np.bincount(owner, minlength=k), set_keys(h, owner, k)
                fresh = np.zeros(k, bool)
                for i in np.flatnonzero(n):
                    if key[i] not in done:
                        if len(done) > 1_000_000:
                            done.clear()
                        done.add(key[i])
                        fresh[i] = True
                use = fresh[owner]
                h, owner = h[use], owner[use]
                most = (n * third).astype(np.int64) + 1
                own, usual = band_of(n), is_common(h, common)
                rows = [lead_values(h, owner, own, most, usual)]
                # a smaller partner (of least * n or more) may lie in the band below, whose sizes end at ``top``
                top = band_top(np.maximum(own - 1, 0))
                low = (own > 0) & (np.ceil(n * least - 1e-6).astype(np.int64) <= top)
                pick = low[owner]
                if pick.any():
                    fewer = np.floor((n + np.minimum(n, top)) * (1 - least) / (1 + least) + 1e-6).astype(np.int64) + 1
                    rows.append(lead_values(h[pick], owner[pick], np.maximum(own - 1, 0), np.minimum(most, fewer), usual[pick]))
                value, who, uncommon = (np.concatenate(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(key[who].view(np.int64)), pa.array((uncommon << 32) | n[who])],
                    names=["value", "node", "weight"])
    return run


def _pairs(least: float):
    """Sorted (value, weight, node) rows of whole groups -> pairs (kind 0) of
    groups up to GROUP; hub pairs (0) and memberships (1) of larger ones.
    Holds one batch and the start of one group."""
    num = int(round(least * 100))

    def fits(x, y):
        lo, hi = np.minimum(x, y) & 0xFFFFFFFF, np.maximum(x & 0xFFFFFFFF, y & 0xFFFFFFFF)
        lo = np.minimum(x & 0xFFFFFFFF, y & 0xFFFFFFFF)
        return 100 * lo >= num * hi

    def frame(a, b, kind):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), kind, np.int32))], names=["a", "b", "kind"])

    def small(v, w, d, begin, size):
        """All pairs of the groups given by begin and size."""
        out = []
        for s in np.unique(size):
            at = begin[size == s][:, None] + np.arange(s)
            i, j = np.triu_indices(int(s), 1)
            x, y = at[:, i].ravel(), at[:, j].ravel()
            ok = fits(w[x], w[y])
            out.append(np.stack([np.minimum(d[x], d[y])[ok], np.maximum(d[x], d[y])[ok]], 1))
        p = np.concatenate(out)
        p = p[np.argsort(mix(p[:, 0].astype(np.uint64)) ^ p[:, 1].astype(np.uint64))]  # equal pairs side by side
        new = np.concatenate([[True], (p[1:] != p[:-1]).any(1)])[:len(p)]
        return frame(p[new, 0], p[new, 1], 0)

    def hub(v, w, d, vh, wh, dh):
        ok = fits(w, np.full(len(w), wh)) & (d != dh)
        yield frame(np.minimum(d[ok], dh), np.maximum(d[ok], dh), 0)
        yield frame(np.full(len(d), vh), d, 1)

    def run(batches):
        keep = [np.zeros(0, np.int64)] * 3  # rows of the last, perhaps unfinished group
        wide = None  # (value, weight, node) of the hub of a large unfinished group
        for b in batches:
            cols = [b.column(c).to_numpy() for c in ("value", "weight", "node")]
            v, w, d = (np.concatenate(x) for x in zip(keep, cols))
            if not len(v):
                continue
            same = np.concatenate([[False], (v[1:] == v[:-1]) & (d[1:] == d[:-1])])
            v, w, d = v[~same], w[~same], d[~same]
            edge = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
            size = np.diff(np.append(edge, len(v)))
            if wide is not None:
                k = size[0] if v[0] == wide[0] else 0
                if k:
                    yield from hub(v[:k], w[:k], d[:k], *wide)
                    edge, size = edge[1:], size[1:]
                if not k or len(edge):
                    wide = None
                if not len(edge):
                    keep = [np.zeros(0, np.int64)] * 3
                    continue
            last, n = edge[-1], size[-1]
            done = size[:-1]
            if n > GROUP:
                wide = (v[last], w[last], d[last])
                yield from hub(v[last:], w[last:], d[last:], *wide)
                keep = [np.zeros(0, np.int64)] * 3
            else:
                keep = [v[last:], w[last:], d[last:]]
            mid = (done > 1) & (done <= GROUP)
            if mid.any():
                yield small(v, w, d, edge[:-1][mid], done[mid])
            for e, s in zip(edge[:-1][done > GROUP], done[done > GROUP]):
                yield from hub(v[e:e + s], w[e:e + s], d[e:e + s], v[e], w[e], d[e])
        if 1 < len(keep[0]):
            yield small(*keep, np.array([0]), np.array([len(keep[0])]))
    return run


def _compare(least: float):
    """Pairs of a block (rows outside the largest component against all) that
    neither sizes nor sketches nor components rule out."""
    num = int(round(least * 100))

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_numpy() for c in ("side", "node", "component", "n")}
        bits = np.stack([table.column(c).to_numpy() for c in _LONGS], 1).view(np.uint64)
        left, right = np.flatnonzero(cols["side"] == 0), np.flatnonzero(cols["side"] == 1)
        ids, comp, n, out = cols["node"], cols["component"], cols["n"], []
        wide = table.column("wide").combine_chunks()
        step = max(1, 200_000 // max(1, len(right)))
        for s in range(0, len(left), step):
            x = left[s:s + step]
            both, least_n = n[x][:, None] + n[right][None], np.minimum(n[x][:, None], n[right][None])
            ok = (comp[x][:, None] != comp[right][None]) & (100 * least_n >= num * (both - least_n))
            i, j = np.nonzero(ok)
            apart = np.bitwise_count(bits[x[i]] ^ bits[right[j]]).sum(1, dtype=np.int64)
            near = np.flatnonzero(apart * (100 + num) <= (100 - num) * both[i, j])
            # the sketches above are as good as full for long texts; these have two bits a shingle
            apart = wide_distances(wide, x[i[near]], right[j[near]])
            near = near[apart * (100 + num) <= (100 - num) * both[i[near], j[near]]]
            a, b = ids[x[i[near]]], ids[right[j[near]]]
            out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        p = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": p[:, 0], "b": p[:, 1]})
    return run


def _sets(words: int):
    def run(batches):
        for b in batches:
            for _, part in text_blocks(b.column("t").to_pylist()):
                h, owner = shingle_sets(part, words)
                n = np.bincount(owner, minlength=len(part))
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_keys(h, owner, len(part)).view(np.int64), mask=n == 0),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))], names=["node", "h"])
    return run


def _near(pairs: DataFrame, nodes: DataFrame, num: int) -> DataFrame:
    """Pairs (a, b) whose sizes and bit sketches allow a link, with sizes."""
    x = nodes.select(F.col("node").alias("a"), F.col("n").alias("an"), *[F.col(c).alias(f"a_{c}") for c in _LONGS])
    y = nodes.select(F.col("node").alias("b"), F.col("n").alias("bn"), *[F.col(c).alias(f"b_{c}") for c in _LONGS])
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in _LONGS[1:]),
                F.bit_count(F.col(f"a_{_LONGS[0]}").bitwiseXOR(F.col(f"b_{_LONGS[0]}"))))
    near = pairs.select("a", "b").distinct().join(x, "a").join(y, "b") \
        .filter((100 * F.least("an", "bn") >= num * F.greatest("an", "bn"))
                & (apart * (100 + num) <= (100 - num) * (F.col("an") + F.col("bn"))))
    near = written(near.select("a", "b", "an", "bn"), "jaccard-near")
    wide = near.join(nodes.select(F.col("node").alias("a"), F.col("wide").alias("aw")), "a") \
        .join(nodes.select(F.col("node").alias("b"), F.col("wide").alias("bw")), "b")
    return written(wide.select("a", "b", "an", "bn", "aw", "bw")
                   .mapInArrow(_close(num), "a long, b long, an long, bn long"), "jaccard-near")


def _close(num: int):
    """Pairs whose wide sketches allow a link."""
    def run(batches):
        for t in batches:
            apart = np.array([sketch_distance(x, y) for x, y in zip(t.column("aw").to_pylist(), t.column("bw").to_pylist())], np.int64)
            size = t.column("an").to_numpy() + t.column("bn").to_numpy()
            yield t.select(["a", "b", "an", "bn"]).filter(pa.array(apart * (100 + num) <= (100 - num) * size))
    return run


def _whole_sets(near: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(node, h) of the nodes in ``near``, from one row's whole text each."""
    ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    where = nodes.join(ends, "node", "left_semi").select(F.col("at.tx").alias("w_tx"), F.col("at.doc_id").alias("w_id"))
    text = docs.join(where, (docs["tx"] == where["w_tx"]) & docs["doc_id"].eqNullSafe(where["w_id"]), "left_semi")
    return written(text.select("t").mapInArrow(_sets(words), "node long, h array<long>").dropDuplicates(["node"]), "jaccard-sets")


def _checked(near: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """The pairs of ``near`` that link, by exact intersection."""
    hit = near.join(sets.select(F.col("node").alias("a"), F.col("h").alias("ah")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("h").alias("bh")), "b") \
        .withColumn("common", F.size(F.array_intersect("ah", "bh")))
    return written(hit.filter(100 * F.col("common") >= num * (F.col("an") + F.col("bn") - F.col("common"))).select("a", "b"), "jaccard-links")


def _joined(near: DataFrame, sets: DataFrame, num: int, known: DataFrame | None = None) -> DataFrame:
    """Components (u, component) of the links in ``near`` and the tree edges
    ``known`` (u, component). First each node meets its neighbour with the most
    candidates; of the other pairs only those that are still apart are checked."""
    both = near.select("a", "b").union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("k"))
    hubs = both.join(degree.select(F.col("a").alias("b"), "k"), "b").groupBy("a").agg(F.max(F.struct("k", "b"))["b"].alias("b"))
    hubs = hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    def edges(df):
        return df.select(F.col("a").alias("u"), F.col("b").alias("v"))
    tree = edges(_checked(near.join(hubs, ["a", "b"], "left_semi"), sets, num))
    if known is not None:
        tree = tree.union(known.select("u", F.col("component").alias("v")))
    parts = connected_components(tree)
    part = parts.select(F.col("u").alias("p"), "component")
    open_ = near.join(part.select(F.col("p").alias("a"), F.col("component").alias("ca")), "a", "left") \
        .join(part.select(F.col("p").alias("b"), F.col("component").alias("cb")), "b", "left") \
        .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", "an", "bn").join(hubs, ["a", "b"], "left_anti")
    more = _checked(written(open_, "jaccard-open"), sets, num)
    if not more.take(1):
        return parts
    return connected_components(parts.select("u", F.col("component").alias("v")).union(edges(more)))


def similarity_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.75, words: int = 5,
                       common_shingles: int = 1 << 18) -> DataFrame:
    """One row per row of ``docs``: doc_id, tx (xxhash64 of the text),
    n_shingles, component (null without shingles) and component_id, the least
    doc_id of the component. ``common_shingles`` bounds the broadcast list that
    only orders the join's values."""
    spark, num = docs.sparkSession, int(round(least * 100))
    small_batches(spark)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).withColumn("tx", F.xxhash64("t"))
    longs = ", ".join(f"{c} long" for c in _LONGS)
    base = written(src.mapInArrow(_sketch(words), f"doc_id long, tx long, n long, node long, {longs}, wide binary, common long"), "jaccard-sketches")
    rows = base.filter("common is null")
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min(F.struct("tx", "doc_id")).alias("at"), F.min("doc_id").alias("least_id"), F.max("n").alias("n"),
        F.any_value("wide").alias("wide"), *[F.max(c).alias(c) for c in _LONGS])
    nodes = written(nodes, "jaccard-nodes")
    shared = base.filter("common is not null").groupBy("common").agg(F.sum("n").alias("n")).filter("n >= 32") \
        .orderBy(F.desc("n"), "common").limit(common_shingles).select("common").toPandas()
    held = spark.sparkContext.broadcast(np.sort(shared["common"].to_numpy(np.int64).view(np.uint64)))

    leads = src.select("t").mapInArrow(_leads(words, num / 100, held), "value long, node long, weight long") \
        .repartition("value").sortWithinPartitions("value", "weight", "node")
    found = written(leads.mapInArrow(_pairs(least), "a long, b long, kind int"), "jaccard-candidates")
    near = _near(found.filter("kind = 0"), nodes, num)
    parts = _joined(near, _whole_sets(near, nodes, src, words), num)

    # large groups: members outside the largest component meet the others
    wide = found.filter("kind = 1").select(F.col("a").alias("value"), F.col("b").alias("node")).distinct()
    if wide.take(1):
        # of groups with the same members one is enough: they hold the same pairs
        alike = wide.groupBy("value").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                          F.sum(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40))).alias("y"))
        wide = wide.join(alike.groupBy("k", "x", "y").agg(F.min("value").alias("value")).select("value"), "value")
        member = wide.join(parts.select(F.col("u").alias("node"), "component"), "node", "left") \
            .withColumn("component", F.coalesce("component", "node"))
        sizes = member.groupBy("value", "component").agg(F.count(F.lit(1)).alias("k"))
        groups = sizes.groupBy("value").agg(F.sum("k").alias("all"), F.max(F.struct("k", "component"))["component"].alias("main"),
                                            F.count(F.lit(1)).alias("parts")).filter("parts > 1")
        groups = groups.join(sizes.select(F.col("value").alias("v2"), F.col("component").alias("c2"), F.col("k").alias("mk")),
                             (F.col("value") == F.col("v2")) & (F.col("main") == F.col("c2"))) \
            .select("value", "main", F.ceil((F.col("all") - F.col("mk")) / BLOCK).cast("int").alias("nl"),
                    F.ceil(F.col("all") / BLOCK).cast("int").alias("nr"))
        member = member.join(groups, "value").join(nodes.select("node", "n", "wide", *_LONGS), "node")
        cols = ["value", "node", "component", "n", "wide", *_LONGS]
        place = lambda k: F.pmod(F.xxhash64("node", F.lit(3)), F.col(k)).cast("int")
        left = member.filter("component <> main").select(*cols, F.lit(0).alias("side"), place("nl").alias("i"),
                                                         F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("j"))
        right = member.select(*cols, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("i"), place("nr").alias("j"))
        more = left.unionByName(right).groupBy("value", "i", "j").applyInArrow(_compare(least), "a long, b long")
        near = _near(more, nodes, num)
        parts = _joined(near, _whole_sets(near, nodes, src, words), num, known=parts)

    # the least id of each class, then of each component
    labelled = nodes.select("node", "least_id").join(parts.select(F.col("u").alias("node"), "component"), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    best = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    label = labelled.select("node", "component").join(best, "component") \
        .select(F.col("node").alias("l_node"), "component", "component_id")
    out = rows.join(label, F.col("node") == F.col("l_node"), "left")
    return out.select("doc_id", "tx", F.col("n").alias("n_shingles"), "component", "component_id")


def similarity_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by
    links, or the row's own) of every row; options as similarity_classes."""
    return similarity_classes(docs, **options) \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: the one with the least id (null ids
    last), then the least text hash; of rows repeated with that id and text,
    one. Rows without shingles all stay. Columns stay as they are."""
    rows = written(similarity_classes(docs).filter("component is not null"), "jaccard-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("tx").alias("tx"))
    keys = rows.groupBy("component", "doc_id", "tx").agg(F.count(F.lit(1)).alias("copies"))
    first = rows.groupBy("component").agg(F.min(rank).alias("first")).select(F.col("component").alias("c2"), "first")
    keys = keys.join(first, F.col("component") == F.col("c2"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("tx") == F.col("first.tx"))
    keys = written(keys.select(F.col("doc_id").alias("k_id"), F.col("tx").alias("k_tx"), "copies", stays.alias("stays")), "jaccard-keys")

    tx = temp_name(docs, "tx")
    have = docs.withColumn(tx, F.xxhash64("text"))

    def same(k: DataFrame) -> Column:
        return have["doc_id"].cast("long").eqNullSafe(k["k_id"]) & (have[tx] == k["k_tx"])

    again = keys.filter("stays and copies > 1")
    gone = keys.filter("not stays or copies > 1")
    out = have.join(gone, same(gone), "left_anti")
    if again.take(1):
        out = out.unionByName(have.join(again, same(again), "left_semi").dropDuplicates(["doc_id", tx]))
    return out.drop(tx)
