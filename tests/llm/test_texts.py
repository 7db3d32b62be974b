"""Suffix-array dedup, SimHash, quality rules, licences: against brute force on small texts."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from brute import fingerprint, fingerprint_components, repeats, without_repeats
from pyspark.sql import functions as F

from tidemart.llm import licenses, simhash
from tidemart.llm.common import write_and_read
from tidemart.llm.components import connected_components
from tidemart.llm.oracle import ORACLE_SQL
from tidemart.llm.quality_rules import repetition_rules
from tidemart.llm.queries import QUERIES
from tidemart.llm.rindex import long_matches
from tidemart.llm.suffix_dedup import count_windows, meet, remove_repeats

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, hash string, n long"  # two columns that clash with inner names


def odd_rows(rng, n=120):
    parts = ["".join(rng.choice("abé ") for _ in range(60)) for _ in range(6)]
    rows = [(i if i % 7 else None, "".join(rng.choice(parts)[rng.randint(0, 20):rng.randint(20, 60)]
                                           for _ in range(rng.randint(0, 5)))) for i in range(n)]
    rows += [(1000, "a" * 300), (1001, "ab" * 90), (1002, None), (1003, ""), (1004, "xyz" * 100), (1004, "xyz" * 100),
             (1005, "b" * 299 + "é"), (1006, " \n\t "), (1007, " ".join(f"w{i}" for i in range(3000)))]
    return [(i, t, "x", 1) for i, t in rows]


@pytest.mark.parametrize("length,anchor,group_bytes", [(40, 10, 4 << 20), (33, 1, 300), (20, 20, 300), (40, 5, 2000)])
def test_suffix_dedup_equals_brute_force(spark, length, anchor, group_bytes):
    rows = odd_rows(random.Random(length))
    df = spark.createDataFrame(rows, DDL).repartition(3)
    got = remove_repeats(df, length=length, anchor=anchor, group_bytes=group_bytes,
                         long_anchor=25 if length == 40 else None).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    want = [(r[0], *w) for r, w in zip(rows, without_repeats([(r[1] or "").encode() for r in rows], length))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_periodic_text_counts_each_window_once(spark):
    texts = [b"ab" * 500, b"ab" * 300 + b"c", b"xyz" * 40, b"xyz" * 6 + b"0123456789"]
    rows = [(i, i, 1, i, 0, 0, bytearray(t)) for i, t in enumerate(texts)]
    pieces = spark.createDataFrame(rows, "k_id long, k_text long, hash long, d0 long, d1 long, begin long, piece binary")
    found = count_windows(pieces, 20).collect()
    assert len(found) < 20  # not a row for each of 1,700 windows, nor 491 of them with one digest
    want = without_repeats(texts, 20)
    for i, (t, w) in enumerate(zip(texts, want)):
        gone = {p for r in found if r["k_id"] == i for p in range(r["begin"], r["stop"])}
        kept = bytes(c for p, c in enumerate(t) if p not in gone)
        assert (len(gone), hashlib.sha256(kept).hexdigest()) == (w[1], w[3])


def test_frequent_keys_meet_without_a_shuffle(spark):
    path = write_and_read(spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"),
                                                   F.col("id").alias("v")), "test-meet")
    counted = path.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k < 3000")
    found = meet(path, counted, ["k"], share=100)
    assert found.columns == path.columns
    assert {r["id"] for r in found.collect()} == {i for i in range(6000) if i % 2 == 0 or i < 3000}
    per_task = meet(path, counted, ["k"], share=100).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 3000  # the key of half the rows is not one task


def test_suffix_dedup_as_text_drops_split_characters(spark):
    df = spark.createDataFrame([(1, "é" + "a" * 9 + "z", "s"), (2, "è" + "a" * 9 + "y", "s")],
                               "doc_id long, text string, source string")
    # the second byte of é and of è differ, so the repeat is the nine letters
    out = {r["doc_id"]: r["kept"] for r in remove_repeats(df, length=9, anchor=3, as_text=True, carry=["source"]).collect()}
    assert out == {1: "éz", 2: "èy"}


def test_query_suffix_dedup_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    want = without_repeats([(t or "").encode() for t in docs.text], 400)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    assert got == dict(zip(docs.doc_id, want))


def test_run_length_index_equals_counting():
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", b"abc\xc3\xa9", bytes(range(255))])
        base = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(5)]
        texts = [b"".join(rng.choice(base)[rng.randint(0, 10):rng.randint(10, 80)] for _ in range(rng.randint(0, 4)))
                 for _ in range(rng.randint(1, 8))]
        for length in (1, 5, 13, 30):
            removed = [w[1] for w in without_repeats(texts, length)]
            got = [0] * len(texts)
            for which, start, stop in long_matches(texts, length):
                got[which] += stop - start
            assert got == removed


def test_query_simhash_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    prints = [fingerprint(t) for t in docs.text]
    want = fingerprint_components(list(docs.doc_id), prints, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_simhash"](spark, SF).collect()}
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(docs.doc_id, prints, want)}


def test_any_four_shared_positions_hold_a_triple():
    from itertools import combinations
    assert all(any(set(t) <= set(c) for t in simhash.TRIPLES) for c in combinations(range(8), 4))


@pytest.mark.parametrize("bits", [4, 3, 1])
@pytest.mark.parametrize("limit", [8192, 2])
def test_fingerprint_links_of_dense_clusters(spark, bits, limit):
    rng = np.random.default_rng(0)
    values = np.unique(np.array([int(b) ^ sum(1 << int(k) for k in rng.choice(40, rng.integers(0, 6), replace=False))
                                 for b in rng.integers(0, 1 << 62, 4) for _ in range(30)], dtype=np.int64))
    want = fingerprint_components([int(v) for v in values], values.view(np.uint64), bits)
    df = spark.createDataFrame([(int(v),) for v in values], "fp long")
    found = {r["node"]: r["component"] for r in
             connected_components(simhash.fingerprint_links(df, bits, limit)).collect()}
    assert [found.get(int(v), int(v)) for v in values] == want


def test_simhash_odd_rows_and_keep_one(spark):
    rows = odd_rows(random.Random(4), 60)
    df = spark.createDataFrame(rows, DDL)
    prints = [fingerprint(r[1]) for r in rows]
    want = fingerprint_components([r[0] for r in rows], prints, 4)
    got = simhash.simhash_components(df).collect()
    assert sorted(str((r["doc_id"], r["component"])) for r in got) == sorted(
        str((r[0], c)) for r, c in zip(rows, want))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    roots = fingerprint_components(list(range(len(rows))), prints, 4)
    assert kept.count() == len(set(roots))  # one row of each group, also among repeated rows


def test_simhash_empty_table(spark):
    empty = spark.createDataFrame([], DDL)
    assert simhash.simhash_components(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert remove_repeats(empty).count() == 0 and repetition_rules(empty).count() == 0
    assert licenses.scan_licenses(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = connected_components(edges.unionByName(edges.limit(3)))
    assert found.agg(F.count("*"), F.max("component")).first() == (301, 0)


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "a a a a a a a", "x y z " * 30] + [
        " ".join(rng.choice(["ab", "é", "cc"]) if rng.random() < .7 else str(rng.random()) for _ in range(rng.randint(0, 70)))
        + rng.choice(["", "\n# $\n# $\n"]) for _ in range(80)]
    df = spark.createDataFrame([(i if i % 5 else None, t, "x", 1) for i, t in enumerate(texts)], DDL).coalesce(2)
    got = sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                  r["repeat_chars"], r["longest_repeat"], r["base_failed"], r["kept"])
                 for r in repetition_rules(df, min_words=4, max_fraction=.2, max_longest=6).collect())
    want = []
    for t in texts:
        words, lines = (t or "").split(), [x for x in (t or "").split("\n") if x.strip()]
        in3, chars, longest = repeats(t, 4)
        total = sum(map(len, words))
        failed = len(words) < 50 or 100 * in3 > 50 * len(words)
        want.append((len(words), total, sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), in3,
                     chars, longest, failed, not failed and chars <= .2 * total and longest <= 6))
    assert got == sorted(want)


def test_quality_rules_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op9_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    good = scored.where("quality = 1 and not base_failed")
    assert good.where("not kept").count() <= 0.01 * good.count()


def test_license_canonical_forms(spark):
    texts = ["RELEASED under the  MIT licence!", "Copyright (c) 2020 A. B.\nreleased under the MIT License", "© 2021 X",
             "hello\nAll rights reserved\nall rights reserved.\nReleased under the MIT License.", None, "",
             "Not released under the MIT License."]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1)], DDL)
    got = {}
    for r in licenses.scan_licenses(df).collect():
        got.setdefault(r["doc_id"], []).append((r["document_license"], r["line_licenses"], r["n_license_lines"]))
    assert got == {0: [("MIT", "MIT", 1)], 1: [("MIT", "MIT", 1)], 2: [(None, "", 0)],
                   3: [(None, "MIT,reserved", 3)] * 2, 4: [(None, "", 0)], 5: [(None, "", 0)], 6: [(None, "", 0)]}


def test_license_texts_are_a_parameter(spark):
    known = spark.createDataFrame([("L-2", "Line one\nline TWO"), ("L-1", "line one, line two."), ("none", None)],
                                  "license_id string, text string")
    df = spark.createDataFrame([(1, "LINE ONE\nLine two", "x", 1)], DDL)
    assert licenses.scan_licenses(df, known).collect()[0]["document_license"] == "L-1"


def test_license_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(map(str, con.execute(ORACLE_SQL["op7_licenses"]).fetchall()))
    assert sorted(str(tuple(r)) for r in QUERIES["op7_licenses"](spark, SF).collect()) == want


def test_license_plan_is_native(spark, capsys):
    licenses.scan_licenses(spark.read.parquet(f"{SF}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_license_texts_inside_documents(spark):
    def shipped(name):
        return next(t for i, t in licenses.default_texts()[len(licenses.NOTICES):] if i == name)

    mit, bsd, gpl = shipped("MIT"), shipped("BSD-3-Clause"), shipped("GPL-3.0")
    n_mit = sum(bool(x.strip()) for x in mit.split("\n"))
    texts = [mit, "MIT License\n\nCopyright (c) 2020 A. B.\n\n" + mit, "Copyright the Foo authors\n\n" + bsd, gpl,
             "Some words first.\n\n" + "\n".join("# " + x for x in mit.split("\n")) + "\nand code after it\n" + mit[:300],
             " ".join(mit.split()), "Words.\nReleased under\nthe MIT License.\n", mit + "\n" + bsd,
             "copyright notices are words\nReleased under the MIT License.", mit.replace("Permission", "No permission")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(4, texts[4], "x", 1)], DDL)
    got = sorted((tuple(r) for r in licenses.scan_licenses(df).collect()), key=str)
    lines = {i: (d, x, n) for i, d, x, n in got}
    assert len(got) == 11 and lines[0] == ("MIT", "MIT", n_mit) and lines[1] == ("MIT", "MIT", n_mit + 1)
    assert lines[2][:2] == ("BSD-3-Clause", "BSD-3-Clause") and lines[3][:2] == ("GPL-3.0", "GPL-3.0")
    assert lines[4] == (None, "MIT", n_mit) and lines[5] == ("MIT", "MIT", 1) and lines[6] == (None, "MIT", 2)
    assert lines[7][:2] == (None, "BSD-3-Clause,MIT") and lines[8] == (None, "MIT", 1) and lines[9] == (None, "", 0)
    few = licenses.scan_licenses(df, limit=3).collect()  # shuffled join, shorter beginnings: the same rows
    assert sorted((tuple(r) for r in few), key=str) == got


def test_license_lines_that_begin_alike_take_linear_time(spark):
    import time
    line = "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
    mit = next(t for i, t in licenses.default_texts()[len(licenses.NOTICES):] if i == "MIT")
    times = []
    for n in (2000, 100000):
        df = spark.createDataFrame([(1, line * n + "Released under the MIT License.\n" + mit, "x", 1)], DDL)
        start = time.time()
        got = licenses.scan_licenses(df).collect()
        times.append(time.time() - start)
        assert [tuple(r) for r in got] == [(1, None, "MIT", 1 + sum(bool(x.strip()) for x in mit.split("\n")))]
    assert times[1] < 60


def test_license_overlapping_units_count_each_line_once(spark):
    known = spark.createDataFrame([("A", "alpha beta gamma delta one\ntwo words here"), ("B", "two words here\nthree more words"),
                                   ("C", "three more words")], "license_id string, text string")
    texts = ["x\nalpha beta gamma delta one\n\n two words here!\nthree more words\nz", "three more words\nthree more words"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DDL)
    got = sorted(tuple(r) for r in licenses.scan_licenses(df, known).collect())
    assert got == [(0, None, "A,B,C", 3), (1, None, "C", 2)]
