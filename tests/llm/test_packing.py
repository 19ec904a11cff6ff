import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from clientlens.llm.packing import Encoder, between_ranges, cut, encoder, matched, pack, pack_pieces
from clientlens.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, uid string, SIZE int, sequence_id string"
SF = "/root/testdata/sf0.001"


def best_fit(sizes, capacity):
    """Sequences that plain best fit in falling order opens."""
    rooms, n = [], 0
    for x in sorted(sizes, reverse=True):
        i = bisect.bisect_left(rooms, x)
        room = rooms.pop(i) if i < len(rooms) else capacity
        n += room == capacity
        if room > x:
            bisect.insort(rooms, room - x)
    return n


def check_places(rows, capacity):
    """rows (sequence, offset, length): gapless from 0, at most capacity."""
    by = {}
    for s, o, n in rows:
        by.setdefault(s, []).append((o, n))
    for places in by.values():
        end = 0
        for o, n in sorted(places):
            assert o == end
            end += n
        assert end <= capacity
    return len(by)


@given(st.lists(st.booleans(), max_size=60))
@settings(max_examples=300, deadline=None)
def test_matched_is_bracket_matching(kinds):
    stack, want = [], {}
    for i, gap in enumerate(kinds):
        if not gap:
            stack.append(i)
        elif stack:
            want[stack.pop()] = i
    piece, its, free, open_ = matched(np.array(kinds, bool))
    assert dict(zip(piece.tolist(), its.tolist())) == want
    assert free.tolist() == stack and len(piece) + len(open_) == sum(kinds)


@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_between_ranges_is_bracket_matching(counts):
    stack, want = [], set()
    for p, (pieces, gaps) in enumerate(counts):
        for g in range(gaps):
            if stack:
                want.add((stack.pop(), (p, g)))
        stack += [(p, i) for i in range(pieces)]
    a, b = between_ranges(dict(enumerate(counts)))
    piece = {number + last - r: (p, r) for p, first, last, number in a for r in range(first, last + 1)}
    gap = {number + r - first: (p, r) for p, first, last, number in b for r in range(first, last + 1)}
    assert piece.keys() == gap.keys() and {(piece[n], gap[n]) for n in piece} == want


def sizes_of(name):
    r = random.Random(4)
    return {"even": [700] * 500, "uniform": [r.randint(1, 2048) for _ in range(900)], "small": [r.randint(1, 60) for _ in range(3000)],
            "copies": [500] * 700 + [r.choice([1100, 900, 30, 2048]) for _ in range(700)], "one": [3], "full": [2048] * 5,
            "long tail": [min(2047, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(1500)]}[name]


@pytest.mark.parametrize("name", ["even", "uniform", "small", "copies", "one", "full", "long tail"])
def test_packs_nearly_as_well_as_plain_best_fit(spark, name):
    sizes = sizes_of(name)
    df = spark.createDataFrame([(i * 7 + (i % 3 << 36), n) for i, n in enumerate(sizes)], "uid long, length long").repartition(4)
    rows = pack_pieces(df).join(df, "uid").collect()
    assert len(rows) == len(sizes) and len({r.uid for r in rows}) == len(sizes)
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 2048)
    least = max(best_fit(sizes, 2048), -(-sum(sizes) // 2048))
    assert n <= least * 1.01 + 2


def test_many_ranges(spark):
    sizes = sizes_of("uniform")
    df = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        rows = pack_pieces(df).join(df, "uid").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert check_places([(r.sequence_id, r.offset, r.length) for r in rows], 2048) <= best_fit(sizes, 2048) * 1.01 + 2


ODD = ["", " ", "<|endoftext|> in text", "don't  stop\n\n", "naïve 漢字 😀 ａ１", "a" * 9000, " " * 2000, "x1!" * 3000, "  \u0085 y", "'s 'T"]


@given(st.text(max_size=40))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_tokenizers_library(text):
    enc = encoder(VOCABULARY)
    assert enc.fast is not None
    assert enc.ids(text).tolist() == enc.exact.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts_and_other_vocabularies():
    enc = encoder(VOCABULARY)
    for t in [*ODD, " " * 1_500_000]:  # the last is too much for tiktoken's matcher
        assert enc.ids(t).tolist() == enc.exact.encode(t, add_special_tokens=False).ids
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None and other.ids("Some words").tolist() == other.exact.encode("Some words", add_special_tokens=False).ids


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def check_pieces(rows, texts, capacity):
    enc, got = encoder(VOCABULARY).exact, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got, key=str) == sorted(texts, key=str)
    for doc, t in texts.items():
        ids = np.array(enc.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(got[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and (len(ids) > capacity or len(pieces) == 1)
        assert all(r.length == capacity for r in pieces[1:]) and sum(r.length for r in pieces) == len(ids)
        end = 0
        for r in pieces:
            assert r.start == end and r.ids_crc32 == zlib.crc32(ids[end:end + r.length].tobytes())
            end += r.length


def test_pack_odd_texts(spark):
    texts = dict(enumerate([*ODD, None])) | {None: "null id"}
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts.items()], SCHEMA)
    rows = pack(df, VOCABULARY, capacity=64).collect()
    check_pieces(rows, texts, 64)
    check_places([(r.sequence_id, r.offset, r.length) for r in rows], 64)
    twice = pack(df.union(df), VOCABULARY, capacity=64).collect()
    assert len(twice) == 2 * len(rows)
    check_places([(r.sequence_id, r.offset, r.length) for r in twice], 64)
    assert pack(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []


def test_query_packs_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_packing"](spark, SF).collect()
    check_pieces(rows, texts, 2048)
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 2048)
    assert n <= max(best_fit([r.length for r in rows], 2048), -(-sum(r.length for r in rows) // 2048)) * 1.01 + 2
