"""Fingerprints bit by bit, the block tables, and the search over hot rows, against plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import simhash
from tallyhouse.llm.neardup import shingle_sets
from tallyhouse.llm.wordhash import mixed

MASK = (1 << 64) - 1


def brute_print(text: str) -> int:
    _, terms, counts = shingle_sets(pa.array([text], pa.large_string()), simhash.TERM_WORDS)
    votes = [0.0] * simhash.BITS
    for term, count in zip(terms, counts):
        both = np.array([term, term ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)
        low, high = (int(x) for x in mixed(both))
        bits = low | high << 64
        for i in range(simhash.BITS):
            votes[i] += (1 if bits >> i & 1 else -1) * (1 + math.log(int(count)))
    return sum(1 << i for i, vote in enumerate(votes) if vote > 0)


def test_bits_are_signed_votes():
    rng = random.Random(5)
    texts = ["", "one", "one two", "a b a b a b c"]
    texts += [" ".join(rng.choices("abcdefgh", k=rng.randrange(3, 80))) for _ in range(30)]
    got = simhash.fingerprints(pa.array(texts, pa.large_string()))
    assert [int(low) | int(high) << 64 for low, high in got] == [brute_print(t) for t in texts]


def test_equal_texts_have_equal_prints_in_any_company():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    text = " ".join(rng.choices(words, k=6000))
    alone = simhash.fingerprints(pa.array([text], pa.large_string()))[0]
    for n in range(1, 12):
        company = [" ".join(rng.choices(words, k=rng.randrange(900))) for _ in range(n)]
        both = simhash.fingerprints(pa.array([*company, text, company[0]], pa.large_string()))
        assert (both[n] == alone).all() and (both[n + 1] == both[0]).all()


@pytest.mark.parametrize("radius", [0, 1, 3, 5, 20, 26, 40])
@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_blocks_cover_the_radius(radius, n):
    blocks = simhash.block_tables(radius, n)
    if radius:
        assert sum(b.width for b in blocks) == simhash.BITS
        assert [b.at for b in blocks[1:]] == [b.at + b.width for b in blocks[:-1]]
        assert sum(b.most + 1 for b in blocks) >= radius + 1
    assert sum(b.asked for b in blocks) <= simhash.MOST_ASKED


def test_blocks_lengthen_with_the_corpus():
    sizes = [10**4, 10**6, 10**8, 10**10]
    layouts = [simhash.block_tables(simhash.RADIUS, n) for n in sizes]
    assert [len(x) for x in layouts] == sorted((len(x) for x in layouts), reverse=True)
    assert len(layouts[0]) > len(layouts[-1])
    # Fingerprints met by chance, as a share of all, fall.
    met = [sum(b.asked / 2**b.width for b in x) for x in layouts]
    assert met[-1] < met[0] / 50


@pytest.mark.parametrize("n", [10, 10**6, 10**8])
def test_every_layout_finds_the_same_pairs(spark, n):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63 - 1, (6, 2))
    rows = [tuple(x) for x in base.tolist()]
    for row in base:
        for flips in (1, 9, 18, 20, 21, 30):
            bits = np.zeros(128, np.uint8)
            bits[rng.choice(128, flips, replace=False)] = 1
            rows.append(tuple((row ^ np.packbits(bits).view(np.int64)).tolist()))
    frame = spark.createDataFrame(rows, "high long, low long")
    asked = spark.createDataFrame(rows[:6], "high long, low long")
    found = sorted(tuple(r) for r in simhash.find_within_radius(asked, frame, 20, n).collect())

    def gap(a, b):
        return sum(((x ^ y) & MASK).bit_count() for x, y in zip(a, b))

    want = [(*a, *b, gap(a, b)) for a in set(rows[:6]) for b in set(rows) if gap(a, b) <= 20]
    assert found == sorted(want) and len(want) == 6 * 5


def test_neither_side_is_broadcast(spark):
    frame = spark.createDataFrame([(1, 2), (3, 4)], "high long, low long")
    text = simhash.find_within_radius(frame, frame)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_links_and_nearest_queries(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    first = rng.choices(words, k=200)
    near = [*first[:100], "other", *first[101:]]
    far = rng.choices(words, k=200)
    a, b, c = " ".join(first), " ".join(near), " ".join(far)
    rows = [(100, a), (200, b), (300, a), (300, a), (1, a), (2, b), (3, c), (400, c), (500, ""), (4, None)]
    rows += [(None, a), (None, "lone text here")]
    docs = spark.createDataFrame(
        [(i, t, "x", 0) for i, t in rows], "doc_id long, text string, part string, high int"
    )
    got = simhash.fingerprint_report(docs).collect()
    value = {t: brute_print(t) for t in (a, b, c, "", "lone text here")}
    asked = [(i, value[t or ""]) for i, t in rows if i is not None and i % 100 == 0]
    want = []
    for doc_id, text in rows:
        own = value[text or ""]
        gaps = [((own ^ q).bit_count(), i) for i, q in asked if i != doc_id]
        gaps = [x for x in gaps if x[0] <= simhash.RADIUS]
        best = min(gaps, default=(None, None))
        want.append((doc_id, len(gaps), best[1], best[0]))
    assert any(d for *_, d in want) and any(n == 0 for _, n, *_ in want)
    found = [(r.doc_id, r.near_queries, r.nearest_query, r.nearest_distance) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(None, " ".join(rng.choices("abcdefghij", k=20))) for _ in range(1500)]
    rows += [(7, "the same text")] * 1500 + [(i, f"text {i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    seen = []

    def watching(df, purpose):
        if purpose == "fingerprints":
            seen.append(df)
        return kept(df, purpose)

    kept = simhash.stored
    monkeypatch.setattr(simhash, "stored", watching)
    figures = simhash.neighbour_figures(docs).collect()
    assert len(figures) == len(rows)
    # One row for each part that has rows holds its last text.
    ends = seen[0].filter("part IS NOT NULL").count()
    assert ends == 8
    by_part = [r["count"] for r in seen[0].selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert max(by_part) < 1.7 * len(rows) / 8
    sha = {r.edited_sha256 for r in figures if r.doc_id == 7}
    # Before its like, before "text 7", and that text itself before the next id.
    assert len(sha) <= 3
