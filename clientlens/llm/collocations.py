"""Phrase collocations by count streams in prefix and suffix order.

Counts of all word sequences of up to ``longest`` words that occur at least
``least`` times form one stream. Range-sorted by their words it is in *prefix
order*: a phrase stands behind its first word, its first two words, and so on,
and right before the phrases that extend it to the right. Range-sorted by their
reversed words it is in *suffix order*, with the same for last words and
extensions to the left. One forward scan of either stream therefore has the
counts of all orders in lockstep: it carries the count of the last sequence of
every length, which is that of the row's own beginning (ending), and the
largest count met since, which is that of the best extension. Nothing is looked
up by a key or a hash; the second pass takes the rows of the first along.

A scan is a task per range. What it can't know - counts that stand before its
first row, extensions that stand behind its last - is one row per task, folded
on the driver (a few numbers a task) and filled in. So a word that begins a
third of all phrases is cut into as many ranges as it needs.

*Counting.* Tasks count blocks of texts on dictionary codes of their words;
the blocks' counts are dealt into buckets, packed, and summed bucket by bucket,
so that no row is a single sequence before it is known to be frequent. Sequences seen fewer than
``least`` times end there; those kept have only kept beginnings and endings.

Defined cases: a null text is empty; a null language counts as ``und``; empty
pieces have no words; repeated rows count each; an empty table gives no rows.
Scores are exact up to counts of 10^16. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from clientlens.llm.shared import small_batches, written
from clientlens.llm.shingles import _TO_LOWER, grouped, mix, word_hashes

#: fixed values of the contract: what ends a piece, what parts its words
_PIECE_END, _WORD_END = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: characters of a counted block, of a bucket's share of the texts; rows that are summed at once; bits of one split
_BLOCK, _BUCKET, _ROWS, _FAN = 4_000_000, 8_000_000, 1_000_000, 11
_DEALT = "lang string, bucket long, data binary"
_CODEC = pa.Codec("zstd", compression_level=1)
_KIND = np.zeros(256, np.uint8)
_KIND[list(_WORD_END)] = 1
_KIND[list(_PIECE_END)] = 2


def count_block(langs: list[str], texts: list[str | None], longest: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """(language, phrase, count, hash of the phrase) of all sequences of a
    block; an empty phrase: the number of words of the language."""
    parts = [t.encode("utf-8", "surrogatepass").translate(_TO_LOWER) if t else b"" for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    kind = _KIND[raw]
    word = kind == 0
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the block ends with a piece's end
    of = pa.array(langs, pa.string()).dictionary_encode()
    lang = of.indices.to_numpy()[np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), start, side="right")].astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(raw[word].tobytes())).dictionary_encode()
    word_id, named = words.indices.to_numpy().astype(np.int64), words.dictionary
    hashed = word_hashes([" ".join(named.to_pylist())])[0]
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    last = np.flatnonzero(np.concatenate([piece[1:] != piece[:-1], [True]]))[:len(start)]
    room = np.repeat(last, np.diff(np.concatenate([[-1], last]))) - np.arange(len(start))  # words that follow in the piece

    total = np.bincount(lang, minlength=len(of.dictionary))
    out = [(np.flatnonzero(total), pa.array([""] * int((total > 0).sum()), pa.string()), total[total > 0], np.zeros(int((total > 0).sum()), np.uint64))]
    at = np.arange(len(start))
    code = lang
    for k in range(1, longest + 1):
        at = at[room[at] >= k - 1]
        if not len(at):
            break
        key, one, inverse = grouped(code[at] * len(named) + word_id[at + k - 1])
        places = at[one]
        phrase = [named.take(pa.array(word_id[places + i])) for i in range(k)]
        h = np.zeros(len(places), np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashed[word_id[places + i]])
        out.append((lang[places], pc.binary_join_element_wise(*phrase, " ") if k > 1 else phrase[0],
                    np.bincount(inverse, minlength=len(key)), h))
        code = np.zeros(len(start), np.int64)
        code[at] = inverse
    who, phrase, c, h = zip(*out)
    return of.dictionary.take(pa.array(np.concatenate(who))), pa.concat_arrays(phrase), np.concatenate(c), np.concatenate(h)


def packed(phrases: pa.StringArray, c: np.ndarray) -> bytes:
    """Phrases and counts as one compressed value."""
    ends = np.frombuffer(phrases.buffers()[1], np.int32)[phrases.offset:phrases.offset + len(phrases) + 1]
    letters = memoryview(phrases.buffers()[2] or b"")[ends[0]:ends[-1]]
    whole = np.uint32(len(c)).tobytes() + np.diff(ends).astype("<u4").tobytes() + c.astype("<i8").tobytes() + bytes(letters)
    return np.uint64(len(whole)).tobytes() + _CODEC.compress(whole, asbytes=True)


def unpacked(data: bytes) -> tuple[pa.StringArray, np.ndarray]:
    whole = _CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    n = int.from_bytes(whole[:4], "little")
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(whole, "<u4", n, 4))]).astype(np.int32)
    return (pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(whole[4 + 12 * n:])),
            np.frombuffer(whole, "<i8", n, 4 + 4 * n))


def _dealt(lang: pa.Array, phrase: pa.StringArray, c: np.ndarray, h: np.ndarray, bits: int):
    """One row for each language and leading ``bits`` of the hash."""
    code = lang.dictionary_encode()
    key = code.indices.to_numpy().astype(np.uint64) << np.uint64(bits)
    if bits:
        key |= h >> np.uint64(64 - bits)
    order = np.argsort(key, kind="stable")
    key, phrase, c = key[order], phrase.take(pa.array(order)), c[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])[:len(key) + 1]) if len(key) else np.zeros(1, np.int64)
    first = key[edge[:-1]]
    rows = [packed(phrase.slice(a, b - a), c[a:b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    return pa.RecordBatch.from_arrays(
        [code.dictionary.take(pa.array((first >> np.uint64(bits)).astype(np.int64))),
         pa.array((first & np.uint64((1 << bits) - 1)).astype(np.int64)), pa.array(rows, pa.binary())], names=["lang", "bucket", "data"])


def _counted(longest: int, bits: int):
    def run(batches):
        langs, texts, size = [], [], 0
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                if texts and size + len(t or "") > _BLOCK:
                    yield _dealt(*count_block(langs, texts, longest), bits)
                    langs, texts, size = [], [], 0
                langs.append(lang)
                texts.append(t)
                size += len(t or "")
        if texts:
            yield _dealt(*count_block(langs, texts, longest), bits)
    return run


def _merged(emit, part_of_bucket: bool):
    """Sorted (lang, bucket, data) rows -> ``emit(lang, phrases, counts)`` of
    every bucket. Counts are summed whenever _ROWS rows have come together;
    with ``part_of_bucket`` a sum of that many rows is put out at once."""
    def summed(held):
        t = pa.table({"p": pa.concat_arrays([p for p, _ in held]), "c": np.concatenate([c for _, c in held])})
        t = t.group_by("p", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
        return (pa.concat_arrays(t.column("p").chunks) if t.num_rows else pa.array([], pa.string())), t.column("c_sum").to_numpy()

    def run(batches):
        key, held, rows, least = None, [], 0, _ROWS
        for b in batches:
            for lang, bucket, data in zip(*(b.column(x).to_pylist() for x in ("lang", "bucket", "data"))):
                if key != (lang, bucket):
                    if held:
                        yield emit(key[0], *summed(held))
                    key, held, rows, least = (lang, bucket), [], 0, _ROWS
                held.append(unpacked(data))
                rows += len(held[-1][1])
                if rows > least:
                    held = [summed(held)]
                    rows = len(held[0][1])
                    least = rows + _ROWS
                    if part_of_bucket and 2 * rows > _ROWS:
                        yield emit(key[0], *held[0])
                        held, rows, least = [], 0, _ROWS
        if held:
            yield emit(key[0], *summed(held))
    return run


def _finer(bits: int):
    def emit(lang, phrases, c):
        n = pc.count_substring(phrases, " ").to_numpy() + pc.not_equal(phrases, "").to_numpy(zero_copy_only=False)
        h = np.zeros(len(n), np.uint64)
        words = word_hashes([" ".join(phrases.to_pylist())])[0]  # an empty phrase has no word
        first = np.cumsum(n) - n
        for i in range(int(n.max(initial=0))):
            has = n > i
            h[has] = mix(h[has] * np.uint64(0x9E3779B97F4A7C15) + words[first[has] + i])
        return _dealt(pa.array([lang] * len(n), pa.string()), phrases, c, h, bits)
    return _merged(emit, part_of_bucket=True)


def _frequent(least: int):
    def emit(lang, phrases, c):
        keep = (c >= least) | pc.equal(phrases, "").to_numpy(zero_copy_only=False)
        phrases = phrases.filter(pa.array(keep))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(c[keep])], names=["lang", "phrase", "c"])
    return _merged(emit, part_of_bucket=False)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10) -> DataFrame:
    """lang, phrase (space-joined), c of the sequences that occur ``least``
    times or more, and one row with an empty phrase per language: its words.

    Counts travel by buckets of the phrase's hash, as one compressed value for
    each block and bucket. There are so many buckets that one of them holds the
    sequences of about _BUCKET characters; where that makes more than 2^_FAN,
    buckets are split in several steps, each by at most 2^_FAN."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("t"))
    size = rows.agg(F.sum(F.length("t").cast("long"))).first()[0] or 0
    bits = max(0, -(-size // _BUCKET) - 1).bit_length()
    steps = [min(bits, i) for i in range(_FAN, bits + _FAN, _FAN)] or [0]
    dealt = rows.mapInArrow(_counted(longest, steps[0]), _DEALT)
    for b in steps[1:]:
        dealt = dealt.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(_finer(b), _DEALT)
    return dealt.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket") \
        .mapInArrow(_frequent(least), "lang string, phrase string, c long")


def _scan(longest: int, names: list[str]):
    """One range of a stream: every row with ``known`` (the counts of its
    beginnings of 1, 2, ... words; null where they stand before the range),
    ``ext`` (largest count of a phrase one word longer) and ``open`` (the range
    ends before it is sure that no more extensions follow); then one row for
    the range: the last counts, the extensions of phrases before the range and
    whether the range ends those phrases."""
    levels = range(1, longest)
    whole = pa.list_(pa.int64())

    def batch(rows: pa.RecordBatch, known, ext, open_, part):
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [*rows.columns, known, pa.array(ext, pa.int64()), pa.array(np.full(n, open_)), pa.array(np.full(n, part, np.int32)),
             pa.nulls(n, whole), pa.nulls(n, pa.list_(pa.bool_()))],
            names=[*names, "known", "ext", "open", "part", "heads", "shut"])

    def run(batches):
        part = TaskContext.get().partitionId()
        last = dict.fromkeys(levels)            # count of the last sequence of each length
        heads = dict.fromkeys(levels)           # largest extension of a sequence before the range
        shut = dict.fromkeys(levels, False)
        held: dict[int, list] = {}              # by length: [row, known, ext] which may still be extended
        schema = None
        for b in batches:
            schema = b.schema
            n = b.num_rows
            if not n:
                continue
            k, f = b.column("k").to_numpy(), b.column("c").to_numpy()
            ext, known = np.zeros(n, np.int64), np.zeros((n, longest - 1), np.int64)
            blank = np.zeros((n, longest - 1), bool)
            stay, new = np.ones(n, bool), {}
            for j in levels:
                header = np.maximum.accumulate(np.where(k == j, np.arange(n), -1))
                before = header < 0
                known[:, j - 1] = np.where(before, last[j] or 0, f[header])
                blank[:, j - 1] = before & (last[j] is None)
                child = k == j + 1
                np.maximum.at(ext, header[child & ~before], f[child & ~before])
                if (child & before).any():
                    most = int(f[child & before].max())
                    if j in held:
                        held[j][2] = max(held[j][2], most)
                    else:
                        heads[j] = max(heads[j] or 0, most)
                ends = np.flatnonzero(k <= j)
                if len(ends):
                    shut[j] = True
                    if j in held:
                        row, kn, e = held.pop(j)
                        yield batch(row, kn, [e], False, part)
                    if k[ends[-1]] == j:
                        new[j] = ends[-1]
                        stay[ends[-1]] = False
                if (k == j).any():
                    last[j] = int(f[header[-1]])
            use = np.arange(longest - 1)[None] < (k - 1)[:, None]
            offsets = np.concatenate([[0], np.cumsum(k - 1)]).astype(np.int32)
            known = pa.ListArray.from_arrays(pa.array(offsets), pa.array(known[use], mask=blank[use]))
            for j, i in new.items():
                held[j] = [b.slice(i, 1), known.slice(i, 1), int(ext[i])]
            keep = pa.array(stay)
            if stay.any():
                yield batch(b.filter(keep), known.filter(keep), ext[stay], False, part)
        for row, kn, e in held.values():
            yield batch(row, kn, [e], True, part)
        if schema is not None:
            one = [pa.nulls(1, schema.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*one, pa.array([[last[j] for j in levels]], whole), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()),
                 pa.array([part], pa.int32()), pa.array([[heads[j] for j in levels]], whole),
                 pa.array([[shut[j] for j in levels]], pa.list_(pa.bool_()))],
                names=[*names, "known", "ext", "open", "part", "heads", "shut"])
    return run


def folded(ranges: list, longest: int) -> list[tuple]:
    """(part, counts that stand before the range, extensions behind it) from
    the ranges' rows (part, known, heads, shut), by length."""
    ranges = sorted(ranges, key=lambda r: r[0])
    before, carry = [], [None] * (longest - 1)
    for _, known, _, _ in ranges:
        before.append(list(carry))
        carry = [x if x is not None else y for x, y in zip(known, carry)]
    behind, carry = [], [0] * (longest - 1)
    for _, _, heads, shut in reversed(ranges):
        behind.append(list(carry))
        carry = [max(h or 0, 0 if s else c) for h, s, c in zip(heads, shut, carry)]
    return [(r[0], b, e) for r, b, e in zip(ranges, before, reversed(behind))]


def _pass(stream: DataFrame, order: str, longest: int, known: str, ext: str) -> DataFrame:
    """``stream`` (lang, c, k and others) with the counts of the beginnings of
    its ``order`` and the best extension in that order."""
    names = stream.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields)
    rows = stream.repartitionByRange("lang", order).sortWithinPartitions("lang", order)
    rows = written(rows.mapInArrow(_scan(longest, names), f"{kinds}, known array<long>, ext long, open boolean, part int, "
                                                         "heads array<long>, shut array<boolean>"), f"phrases-{known}")
    ranges = rows.filter("heads is not null").select("part", "known", "heads", "shut").collect()
    edges = stream.sparkSession.createDataFrame(folded([tuple(r) for r in ranges], longest),
                                                "e_part int, e_known array<long>, e_ext array<long>")
    rows = rows.filter("heads is null").join(F.broadcast(edges), F.col("part") == F.col("e_part"))
    full = F.transform("known", lambda x, i: F.coalesce(x, F.get("e_known", i)))
    best = F.when(F.col("open"), F.greatest("ext", F.get("e_ext", F.col("k") - 1))).otherwise(F.col("ext"))
    return rows.select(*names, full.alias(known), best.alias(ext))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10,
                 covered: int = 50, top: int | None = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: phrases of 2 to ``longest``
    words that occur ``least`` times or more, scored by their weakest cut:
    floor(10^6 * a * a / (l * r)). A phrase is dropped if one that contains it
    has ``covered`` percent of its occurrences. ``top`` of each language, best
    first (None: all)."""
    counts = written(phrase_counts(docs, text, lang, longest, least), "phrases")
    words = F.split("phrase", " ")
    stream = counts.filter("phrase <> ''").select("lang", words.alias("w"), F.reverse(words).alias("v"), "c",
                                                        F.size(words).alias("k"))
    rows = _pass(_pass(stream, "w", longest, "lefts", "right_ext"), "v", longest, "rights", "left_ext")
    rows = rows.filter(f"k > 1 and 100 * greatest(right_ext, left_ext) < {int(covered)} * c")

    d = "decimal(38,0)"

    def cut(i: int):
        l, r = f"lefts[{i - 1}]", f"get(rights, k - {i + 1})"
        score = F.expr(f"cast(cast(c as {d}) * cast(c as {d}) * 1000000 as {d}) div "
                       f"cast(cast({l} as {d}) * cast({r} as {d}) as {d})")
        return F.when(F.col("k") > i, F.struct(score.alias("score"), F.lit(i).alias("cut"), F.expr(l).alias("l"), F.expr(r).alias("r")))

    cuts = F.array_compact(F.array(*[cut(i) for i in range(1, longest)]))
    rows = rows.withColumn("best", F.array_min(cuts)).select(
        "lang", F.concat_ws(" ", "w").alias("phrase"), F.col("c").alias("a"), F.col("best.l").alias("l"),
        F.col("best.r").alias("r"), F.col("best.score").alias("score"), F.col("best.cut").alias("cut"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = rows.withColumn("rank", rank.cast("long"))
    if top is not None:
        rows = rows.filter(F.col("rank") <= top)
    n = counts.filter("phrase = ''").select(F.col("lang").alias("n_lang"), F.col("c").alias("n"))
    return rows.join(n, F.col("lang") == F.col("n_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
