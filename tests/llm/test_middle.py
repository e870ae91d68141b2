"""Fill-in-middle against a plain rebuilding of the contract, and on odd input."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from armorica.llm import middle


def test_skip_list_reaches_every_rank():
    rng = random.Random(1)
    for n in [*range(70), 1000, 20_000]:
        points = np.array([rng.randrange(1, 90) for _ in range(n)], np.int64)
        lanes, ends = middle.SkipList(points), [0, *np.cumsum(points).tolist()]
        ranks = range(n + 1) if n < 2000 else rng.sample(range(n + 1), 500)
        assert all(lanes.points_before(rank) == ends[rank] for rank in ranks), n
    with pytest.raises(IndexError):
        lanes.points_before(n + 1)


def test_express_lanes_get_sparser():
    lanes = [len(widths) for widths, _, _ in middle.SkipList(np.ones(50_000, np.int64))._lanes]
    assert lanes == sorted(lanes) and len(lanes) > 4 and lanes[0] < 50


def _plainly(doc_id, text, seed=7, cut=100, spm=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(mark in text for mark in marks) or h[2] % 100 >= cut:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(lines), "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return len(lines), "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


def _texts():
    rng = random.Random(2)
    pieces = ["line", "\n", "\n\n", "é", "\U0001f642", "\r\n", "<", ">", "<P", "S>", " ", " ", "\x85", "|", ""]
    return [(i, "".join(rng.choices(pieces, k=rng.randrange(60)))) for i in range(400)] + [
        (1000, "has <M> in it\n"),
        (1001, "\n" * 5000),
        (1002, "x" * 200_000),
        (1003, "no end"),
        (None, "a\nb\nc\n"),
        (1004, None),
        (1004, "a\nb"),
        (1004, "a\nb"),
    ]


@pytest.mark.parametrize("options", [{}, {"cut_percent": 60, "spm_percent": 0, "seed": 3, "marks": ("<|p|>", "<|s|>", "<|m|>")}])
def test_cuts_equal_plain_rebuilding(spark, options):
    rows = spark.createDataFrame(_texts(), "doc_id bigint, text string")
    marks = options.get("marks", middle.MARKS)
    cut = middle.fill_in_middle(rows, **options).withColumn("again", middle.restore(F.col("fim.output"), F.col("fim.form"), marks))
    found = cut.collect()
    names = {"cut_percent": "cut", "spm_percent": "spm"}
    want = {names.get(name, name): value for name, value in options.items()}
    assert len(found) == len(_texts()) and {row.fim.form for row in found} >= {"plain", "psm"}
    for row in found:
        assert tuple(row.fim) == _plainly(row.doc_id, row.text, **want)
        assert row.again == (row.text or "")


def test_odd_rows(odd_docs, no_docs):
    clashing = odd_docs.withColumnsRenamed({"anchor": "n", "rank": "form"})
    found = middle.fill_in_middle(clashing)
    assert found.columns == [*clashing.columns, "fim"] and found.count() == odd_docs.count()
    assert all(tuple(row.fim) == _plainly(row.doc_id, row.text) for row in found.collect())
    assert middle.fill_in_middle(no_docs).count() == 0
    with pytest.raises(ValueError):
        middle.fill_in_middle(odd_docs, marks=("<P>", "<P>", "<M>"))
