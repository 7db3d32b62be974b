"""Collocations against plain counting, and the filters on their own."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import collocations
from tidemart.llm.collocations import Layout, build, decode, encode, merge, mine_collocations

DOCS = "doc_id long, text string, lang string, w array<long>, a int, rank int"


def expected(rows, least=30, top=2000, covered=80):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every piece."""
    out = []
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by_lang.items():
        f = Counter()
        for text in texts:
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            for piece in re.split("[.,;:!?\x0a-\x0d]", low):
                w = re.findall("[^\x20\x09]+", piece)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if 2 <= len(p) <= 4 and c >= least}
        inside = {}
        for p, c in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside.get(p[i:i + k], 0), c)
        ranked = []
        for p, a in found.items():
            if 100 * inside.get(p, 0) >= covered * a and p in inside:
                continue
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            ranked.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def text(rng, words, n):
    ends = [" ", " ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b", "\r\n", ";"]
    return "".join(rng.choice(words) + rng.choice(ends) for _ in range(n))


def test_odd_rows_equal_counting(spark):
    rng = random.Random(3)
    few, many = ["a", "B", "the", "É", "x-y", "\x01", "naïve", "\x1f", "\xa0"], [f"w{i}" for i in range(60)]
    rows = [(i, text(rng, few if i % 3 else many, rng.randint(0, 200)), rng.choice(["en", "de", None, "und", ""]))
            for i in range(300)]
    rows += [(1, None, "en"), (1, "", None), (2, "...!!", "fr"), (None, "one two three four five " * 40, "fr"),
             (None, "one two three four five " * 40, "fr"), (7, "same " * 5000, "de"), (8, "q" * 200000, None)]
    df = spark.createDataFrame([(i, t, lang, None, 0, 0) for i, t, lang in rows], DOCS)
    want = expected([r[1:] for r in rows], least=5, top=40)
    assert result(mine_collocations(df, least=5, top=40)) == want and len(want) > 150
    # a third of all rows and words in one phrase, and the least count itself
    edge = [(i, "hot pair" if i % 3 else f"u{i} v{i}", "en") for i in range(90)] + [(0, "thirty times", "en")] * 30 + [
        (0, "not enough", "en")] * 29
    df = spark.createDataFrame([(i, t, lang, None, 0, 0) for i, t, lang in edge], DOCS)
    assert [r[2] for r in result(mine_collocations(df))] == ["hot pair", "thirty times"]


def test_empty_and_without_candidates(spark):
    assert mine_collocations(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, None, None, None, 0, 0), (2, "once only", "en", None, 0, 0)], DOCS)
    assert mine_collocations(df).count() == 0


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(text(rng, ["a", "b", "c", "dd"], 2000), "en"), (text(rng, ["a", "e", "f"], 3000), None)]
    tables = [b for t, lang in rows for b in [pa.RecordBatch.from_arrays(
        [pa.array([lang or "und"]), pa.array([t])], names=["lang", "t__"])]]
    monkeypatch.setattr(collocations, "SEGMENT_BYTES", 100)
    found, words = Counter(), Counter()
    for s in collocations.cut_segments(iter(tables)):
        lang, lead = s.column("lang")[0].as_py(), s.column("lead")[0].as_py()
        names = [None, *s.column("words")[0].as_py()]
        w = [names[i] for i in np.frombuffer(s.column("tokens")[0].as_py(), dtype=collocations.token_type(len(names) - 1))]
        words.update({(lang, x): c for x, c in zip(names[1:], s.column("counts")[0].as_py())})
        for k in (2, 3, 4):
            for i in range(len(w) - k + 1):
                if None not in w[i:i + k] and i + k > lead:
                    found[lang, " ".join(w[i:i + k])] += 1
    plain = Counter()
    for t, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = re.findall("[^ \t]+", piece)
            plain.update((lang or "und", " ".join(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    assert found == {p: c for p, c in plain.items() if " " in p[1]}
    assert {p: c for p, c in words.items() if c} == {p: c for p, c in plain.items() if " " not in p[1]}


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 31, 32])
def test_permutation_is_invertible(bits):
    layout = Layout(bits, 10 ** 6, 64)
    rng = np.random.default_rng(bits)
    left, right = (rng.integers(0, 1 << 2 * bits, 1000, dtype=np.uint64) for _ in range(2))
    a, b = layout.permute(left, right)
    assert max(a.max(), b.max()) < 1 << 2 * bits
    c, d = layout.restore(a, b)
    assert (c == left).all() and (d == right).all()


@pytest.mark.parametrize("bits,phrases,blocks", [(2, 10, 1), (9, 10 ** 5, 8), (16, 10 ** 7, 64), (20, 10 ** 9, 64), (31, 10 ** 13, 96)])
def test_filters_hold_and_merge_exact_counts(bits, phrases, blocks):
    layout = Layout(bits, phrases, blocks)
    rng = np.random.default_rng(bits)
    ids = rng.integers(1, min(1 << bits, 300), (4000, 4), dtype=np.uint64)
    ids[:2000, 2:] = 0
    left, right = (ids[:, 0] << np.uint64(bits)) | ids[:, 1], (ids[:, 2] << np.uint64(bits)) | ids[:, 3]
    weight = rng.integers(1, 600, 4000)
    weight[:3] = [1, 254, 1 << 40]
    want = Counter()
    for w, c in zip(ids.tolist(), weight.tolist()):
        want[tuple(w)] += c
    shards = []
    for s in range(0, 4000, 1000):
        k = slice(s, s + 1000)
        held = layout.tally(*layout.permute(left[k], right[k]), weight[k])
        for b in encode(*held, layout):
            for got, kept in zip(decode(b, layout), held):
                assert (got == kept).all()
            shards += [b.slice(i, 1) for i in range(b.num_rows)]
    shards.sort(key=lambda b: b.column("block")[0].as_py())
    table = pa.Table.from_batches(shards).combine_chunks().to_batches()
    for least in (1, 500):
        got = Counter()
        for b in merge(iter(table), layout, least):
            for *w, a in zip(*[b.column(c).to_pylist() for c in ("w1", "w2", "w3", "w4", "a")]):
                got[tuple(w)] += a
        assert got == {w: a for w, a in want.items() if a >= least}


def test_pairs_that_agree_in_64_bits_stay_apart():
    layout = Layout(31, 10 ** 6, 64)  # 124 bits
    left = np.array([5, 5, 5, 5, 9, 5], dtype=np.uint64)
    right = np.array([1 << 40, 1, 1 << 40, 1, 1, 3], dtype=np.uint64)
    got = layout.tally(left, right, np.arange(1, 7))
    assert sorted(zip(*(x.tolist() for x in got))) == [(5, 1, 6), (5, 3, 6), (5, 1 << 40, 4), (9, 1, 5)]
    got = layout.tally(left, right, None)
    assert sorted(zip(*(x.tolist() for x in got))) == [(5, 1, 2), (5, 3, 1), (5, 1 << 40, 2), (9, 1, 1)]


def test_segments_of_many_words(spark):
    texts = [" ".join(f"w{i}" for i in range(70000)) + " a b c a b c", "a b c"]
    df = spark.createDataFrame([(i, t, "en", None, 0, 0) for i, t in enumerate(texts)], DOCS)
    assert result(mine_collocations(df, least=3)) == expected([(t, "en") for t in texts], least=3)


def test_full_filters_are_emitted_early(monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_ENTRIES", 50)
    layout = Layout(8, 10 ** 4, 4)
    rng = np.random.default_rng(1)
    tokens = [rng.integers(0, 9, 200).astype(np.uint16) for _ in range(6)]
    coded = pa.RecordBatch.from_arrays(
        [pa.array([0, 3] * 3, pa.int32()), pa.array([t.tobytes() for t in tokens], pa.binary()),
         pa.array([8] * 6, pa.int32()), pa.array([[0, 2, 4]] * 6), pa.array([[5, 9, 200]] * 6)],
        names=["lead", "tokens", "words", "at", "id"])
    rows = [b.slice(i, 1) for b in build(iter([coded]), layout) for i in range(b.num_rows)]
    rows.sort(key=lambda b: b.column("block")[0].as_py())
    got = Counter()
    for b in merge(iter(rows), layout, 1):
        for *w, a in zip(*[b.column(c).to_pylist() for c in ("w1", "w2", "w3", "w4", "a")]):
            got[tuple(w)] += a
    names, want = {1: 5, 3: 9, 5: 200}, Counter()
    for t, lead in zip(tokens, [0, 3] * 3):
        w = [names.get(x, 0) for x in t.tolist()]
        for k in (2, 3, 4):
            for i in range(len(w) - k + 1):
                if 0 not in w[i:i + k] and i + k > lead:
                    want[tuple(w[i:i + k]) + (0,) * (4 - k)] += 1
    assert got == want
