from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from civiclake.llm import line_dedup, queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.1"
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FOOTER = "All rights reserved, 2024."


def brute(rows, least_length=20, least_documents=3):
    """(doc_id, n_lines, n_dropped, digest) of each row; rows with a null id count nowhere."""
    key = lambda line: line.strip(WHITE).translate(LOWER)
    homes = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least_length:
                homes[key(line)].add(doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(homes[key(x)]) < least_documents or doc == max(homes[key(x)])]
        found.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(found, key=repr)


def digests(table, **limits):
    return sorted((tuple(r) for r in line_dedup.dedup_digests(table, **limits).collect()), key=repr)


def table(spark, rows):
    """With extra columns named like those the operator uses."""
    odd = [(*r, 1, 2, "x") for r in rows]
    return spark.createDataFrame(odd, "doc_id long, text string, version int, position int, `my col` string").repartition(5)


ODD = [
    (1, None), (2, ""), (3, "\n"), (4, FOOTER), (5, f"\n{FOOTER}\n\n{FOOTER}"), (6, f"  {FOOTER.upper()}\t\r\nshort\nshort"),
    (7, f"{FOOTER}\nİstanbul ÄÖÜ long enough line"), (8, "i̇stanbul äöü long enough line\nshort"), (None, FOOTER), (None, None),
    (9, "19 code points long"), (10, "19 code points long"), (11, "19 code points long"), (12, "ä" * 20), (13, "ä" * 20), (14, "Ä" * 20), (15, "ä" * 20),
    (16, " " + FOOTER), (7, "another text of seven\n" + FOOTER), (4, FOOTER), (4, FOOTER), (-5, FOOTER + "\n"),
]


def test_odd_rows(spark):
    assert digests(table(spark, ODD)) == brute(ODD)
    # The repeated rows of 4 are one document, so two documents are too few.
    few = [(4, FOOTER), (4, FOOTER), (4, FOOTER), (6, FOOTER)]
    assert digests(table(spark, few)) == brute(few) and all(r[2] == 0 for r in brute(few))


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [(1, None)]):
        assert digests(table(spark, rows) if rows else table(spark, ODD).limit(0)) == brute(rows)


@pytest.mark.parametrize("share, least", [(1024, 4096), (1024, 5), (40, 20)])
def test_hot_lines_go_another_way_to_the_same_result(spark, monkeypatch, share, least):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    monkeypatch.setattr(line_dedup, "HOT_LEAST", least)
    rng = random.Random(4)
    lines = [f"{i} is the number of this line of text" for i in range(60)] + ["short", ""]
    rows = [(d, "\n".join(rng.choices(lines, k=rng.randrange(1, 12)) + [FOOTER] * rng.randrange(2))) for d in range(300)]
    got = digests(table(spark, rows))
    assert got == brute(rows) and sum(r[2] for r in got) > 500


def test_very_long_documents(spark):
    long = "\n".join(f"line {i % 5000} of a very long document" for i in range(20_000))
    rows = [(1, long), (2, long), (3, "\n".join(f"line {i} of a very long document" for i in range(0, 5000, 7))), (4, "x" * 300_000)]
    assert digests(table(spark, rows)) == brute(rows)


def test_bitmaps_skip_words_that_keep_all(spark):
    rows = [(d, "\n".join([f"a line of document {d}, number {i}" for i in range(200)] + [FOOTER] + [f"after, {d}, {i}, and on" for i in range(100)])) for d in range(3)]
    got = {r.doc_id: r for r in line_dedup.keep_bitmaps(table(spark, rows)).collect()}
    assert set(got) == {0, 1}  # the last document keeps its line and has no bitmap
    for r in got.values():
        assert r.n_dropped == 1 and [(w.skip, w.keep) for w in r.bitmap] == [(3, ~(1 << 8))]
    whole = line_dedup.cut(table(spark, rows), line_dedup.keep_bitmaps(table(spark, rows)))
    assert whole.select("document.*").columns == ["doc_id", "text", "version", "position", "my col"]


def test_main_path_is_native_and_ranges_serve_the_windows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = line_dedup.dropped_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    window = plan[plan.index("Window") : plan.index("rangepartitioning")]
    assert "hashpartitioning" not in window and window.count("Sort [high") == 1


def test_op13_against_sql_and_brute_force(spark):
    got = queries.op13_line_dedup(spark, SF)
    assert differences(got, connect(SF), queries.ORACLE["op13_line_dedup"]) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text")).collect()]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
