"""Spelling variants against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from armorica.llm import queries, spelling


def _edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _plainly(counts, ratio=10):
    near = {a: [b for b in counts if abs(len(a) - len(b)) < 2 and _edits(a, b) == 1] for a in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * counts[word] else None

    def root(word):
        while forms[word] is not None:
            word = forms[word]
        return word

    return {w: (forms[w], root(w), n, len(near[w]), counts.get(forms[w])) for w, n in counts.items()}


def _words(number, letters, seed=4):
    rng = random.Random(seed)
    counts = {}
    while len(counts) < number:
        word = "".join(rng.choices(letters, k=rng.randrange(1, 7)))
        counts[word] = rng.choice([1, 1, 2, 3, 10, 30, 100, 1000, 10_000])
    return counts


def _found(frame):
    rows = frame.collect()
    found = {row.word: (row.form, row.root, row.n, row.n_near, row.form_n) for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(("held", "visitors"), [(8192, 16_384), (40, 30), (3, 2)])
def test_variants_equal_brute_force(spark, held, visitors):
    counts = _words(400, "abcdeéü") | {"": 5}
    long = "long" * 5000
    words = spark.createDataFrame([*counts.items(), (long, 1), (long + "s", 40)], "word string, n bigint").repartition(7)
    found = _found(spelling.spelling_variants(words, held_words=held, visitors=visitors))
    assert found.pop(long) == (long + "s", long + "s", 1, 1, 40) and found.pop(long + "s") == (None, long + "s", 40, 1, None)
    assert found == _plainly(counts)


def test_words_of_equal_counts_are_split(spark):
    # All of one cell however deep: letters of one group.
    letters = "".join(chr(97 + 11 * i) for i in range(4))
    counts = {word: n for word, n in _words(300, letters).items() if len(word) > 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert _found(spelling.spelling_variants(words, held_words=16, visitors=8)) == _plainly(counts)


def test_forms_are_followed(spark):
    chain = {"a" * 6 + "b" * i: 10**i for i in range(10)}
    words = spark.createDataFrame(list(chain.items()), "word string, n bigint")
    assert _found(spelling.spelling_variants(words)) == _plainly(chain)
    assert _found(spelling.spelling_variants(words))["a" * 6][1] == "a" * 6 + "b" * 9


def test_ties_and_odd_rows(spark):
    rows = [("word", 1), ("wort", 20), ("ward", 20), ("word", 1), (None, 4), ("gone", None), ("gone", 0)]
    words = spark.createDataFrame([(w, n, 1, "x") for w, n in rows], "word string, n int, cell int, near string")
    found = _found(spelling.spelling_variants(words))
    assert found["word"] == ("ward", "ward", 2, 2, 20) and "gone" not in found and None not in found
    assert spelling.spelling_variants(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(words, ratio=1)


def test_one_apart_is_one_edit():
    rng = random.Random(8)
    pairs = [tuple("".join(rng.choices("ab", k=rng.randrange(6))) for _ in range(2)) for _ in range(20_000)]
    pairs += [("x" * n + a, "x" * n + b) for n in (26, 28, 30, 50) for a, b in pairs[:300]]
    pairs += [("\U0001f642" + a, "\U0001f643" + b) for a, b in pairs[:300]]
    want = [_edits(a.lstrip("x"), b.lstrip("x")) == 1 for a, b in pairs]
    assert [spelling.one_apart(a, b) for a, b in pairs] == want
    left, right = (spelling.Features(list(part)) for part in zip(*pairs, strict=True))
    at = np.arange(len(pairs))
    assert spelling.pairs_apart(left, at, right, at).tolist() == want


def test_trie_finds_all_pairs():
    words = list(_words(2000, "abcdefghijk"))
    at, others = spelling.Trie(spelling.Features(words)).near(spelling.Features(words))
    found = set(zip(at.tolist(), others.tolist(), strict=True))
    assert len(found) == len(at) > 1000
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if spelling.one_apart(a, b)}


def test_letter_runs_of_odd_rows(spark, odd_docs, no_docs):
    runs = {row.run for row in spelling.letter_runs(odd_docs, min_chars=4).collect()}
    assert {"same", "words", "alpha", "without"} <= runs and "the" not in runs
    assert queries.misspelt_words(no_docs).count() == 0
    rows = spark.createDataFrame([(None, "ÀÉ Straße×2 O'Neill"), (1, None)], "doc_id bigint, text string")
    assert [row.run for row in spelling.letter_runs(rows).collect()] == ["ÀÉ", "straße×", "o", "neill"]
