"""Hot hosts, rows without an id, repeats of one id, and clashing names, against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import quality, substring, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return line.lower().strip(" \t\n\x0b\x0c\r")


@pytest.fixture(scope="module")
def shared_lines():
    """A host with most rows, where a line is frequent far below a tenth of its documents."""
    rows = []
    for i in range(600):
        lines = [f"own line of {i} with several words of its own number {i}"]
        if i % 20 == 0:
            lines.insert(0, "  Sign UP for our letter today  ")
        if i % 25 == 0:
            lines += ["all rights reserved here", "", "All Rights Reserved here"]
        rows.append((i, "\n".join(lines), "hot" if i % 3 else None, i))
    rows += [(1000 + i, "sign up for our letter today\nten words of text that are nowhere else at all", "cold", i) for i in range(15)]
    rows += [(2000 + i, f"sign up for our letter today\nread more stories like this one on our home page\nleft {i} over", "hot", i) for i in range(25)]
    rows += [(3000 + i, rows[1][1], "hot", i) for i in range(50)]
    return [*rows, (None, None, "hot", 0), (None, "", None, 0), (4000, "\n \n\t", "hot", 0), rows[0], rows[0]]


def brute_kept(rows, limits):
    holders = defaultdict(set)
    for _, text, host, _ in rows:
        for line in (text or "").split("\n"):
            if normal(line):
                holders[host, normal(line)].add(text)
    frequent = {key for key, texts in holders.items() if len(texts) > limits.min_documents}
    for doc_id, text, host, _ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if (host, normal(x)) not in frequent]
        n, gone = len(WORD.findall(text or "")), sum(len(WORD.findall(x)) for x in lines if x not in left)
        yield doc_id, host, text if gone == 0 else "\n".join(left), gone, n - gone >= limits.min_kept * n


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_frequent_lines_in_broadcast_and_in_shuffle(spark, shared_lines, limit):
    names = "doc_id long, text string, source string, document long"
    docs = spark.createDataFrame(shared_lines, names)
    limits = quality.LineLimits()
    got = quality.judge_quality(docs, limits, limit=limit).collect()
    want = Counter(brute_kept(shared_lines, limits))
    assert any(not kept for *_, kept in want) and len({gone for *_, gone, _ in want}) > 2
    assert want == Counter(
        (r.row.doc_id, r.row.source, r.kept_text, r.removed_words, r.kept or r.base_failed and kept_of(want, r))
        for r in got
    )
    report = quality.quality_report(docs, limits, limit=limit).collect()
    assert Counter((r.doc_id, r.removed_words, r.kept) for r in report) == Counter(
        (r.row.doc_id, r.removed_words, r.kept) for r in got
    )


def kept_of(want, r):
    """The line rule's verdict of a row that the base rules reject."""
    return next(k for d, h, t, g, k in want if (d, h, t, g) == (r.row.doc_id, r.row.source, r.kept_text, r.removed_words))


def test_lines_of_most_rows_are_joined_apart(spark, shared_lines, monkeypatch):
    monkeypatch.setattr(quality, "_HOT", 20)
    docs = spark.createDataFrame(shared_lines, "doc_id long, text string, source string, document long")
    apart = quality.quality_report(docs, limit=0).collect()
    assert Counter(apart) == Counter(quality.quality_report(docs).collect())


def test_substrings_of_rows_without_id_and_of_repeated_ids(spark):
    def text(i):
        return " ".join([*(f"p{k}" for k in range(20)), f"own{i}", *(f"q{i % 4}x{k}" for k in range(15))])

    rows = [(i, text(i)) for i in range(30)] + [(None, text(100 + i)) for i in range(40)]
    rows += [(7, text(200 + i)) for i in range(40)] + [(7, text(7)), (None, None), (7, None)]
    least = {}
    for doc_id, said in rows:
        ws = WORD.findall(said or "")
        for k in range(len(ws) - 12):
            if doc_id is not None:
                key = tuple(ws[k : k + 13])
                least[key] = min(doc_id, least.get(key, doc_id))
    want = Counter()
    for doc_id, said in rows:
        ws = WORD.findall(said or "")
        gone = set()
        for k in range(len(ws) - 12):
            if doc_id is not None and least[tuple(ws[k : k + 13])] < doc_id:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        want[doc_id, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in substring.removal_report(docs).collect()) == want


def test_toxicity_with_clashing_names_and_repeated_ids(spark):
    rows = [(i, f"{'vileling' if i % 2 else 'gentle'} word of text {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(200)], "doc_id long, toxic int, quality int")
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = plain.withColumns({"id": F.lit("x"), "toxic": 1 - F.col("doc_id") % 2, "text_id": F.lit(1)})
    score = {r.doc_id: r.score for r in toxicity.toxicity_report(plain, labels).collect()}
    assert {r.doc_id: r.score for r in toxicity.toxicity_report(names, labels).collect()} == score
    repeated = plain.unionAll(plain.filter("doc_id = 1")).unionAll(
        spark.range(500).selectExpr("1L AS doc_id", "'' AS text")
    )
    again = {(r.doc_id, r.score) for r in toxicity.toxicity_report(repeated, labels).collect() if r.doc_id != 1}
    assert again == {(i, s) for i, s in score.items() if i != 1}


def test_toxicity_without_labels_predicts_nothing(spark):
    docs = spark.createDataFrame([(1, "a word"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r.predicted for r in toxicity.toxicity_report(docs, none).collect()] == [0, 0]
    assert toxicity.fit(pa.array(["a", "b"]), pa.array([1, 1]).to_numpy()).intercept > 0
