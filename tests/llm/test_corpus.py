"""Corpus operators against brute force, round trips and held-out labels, and on odd input."""

from __future__ import annotations

import collections
import os
import random
import re
import tracemalloc

import numpy as np
import pytest
from compare import connect, difference
from pyarrow import fs
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from armorica.llm import chat, decontaminate, langid, mixing, phrases, pii, queries, simhash, tokens, toxicity, vptree

SQL = [name for name, query in queries.QUERIES.items() if query.sql]


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, duck, tables, name):
    query = queries.QUERIES[name]
    assert difference(query.run(spark, tables), duck, query.sql) is None


COLUMNS = {
    "op1_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_pii_pseudonyms": ["doc_id", "text"],
    "op3_decontamination": ["doc_id", "item_id"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_simhash_groups": ["doc_id", "fingerprint", "component_id"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op10_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
}


@pytest.mark.parametrize("name", [name for name, query in queries.QUERIES.items() if not query.sql])
def test_query_gives_its_columns(spark, docs, tables, name):
    found = queries.QUERIES[name].run(spark, tables)
    assert set(COLUMNS[name]) <= set(found.columns)
    number = found.count()
    assert number > 0 if name == "op3_decontamination" else number == docs.count()


# --- token ids


def _tokenizer(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_encoder_equals_whole_texts(token_file):
    with open(token_file, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read(), 2)
    tokenizer, rng = _tokenizer(token_file), random.Random(3)
    pieces = ["word", "été", "a", "'s", " ", "  ", "\n", "\t", "12", "!", ",", " ", "\x1c", "<|endoftext|>", "\U0001f642", "​", " \n"]
    texts = ["".join(rng.choices([*pieces, " ", " "], k=rng.randrange(30))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_round_trip(spark, odd_docs, token_file):
    found = tokens.read_tokens(spark, tokens.write_tokens(odd_docs, token_file, end_id=2)).collect()
    tokenizer = _tokenizer(token_file)
    want = collections.Counter(
        (row.doc_id, tuple(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2])) for row in odd_docs.collect()
    )
    assert collections.Counter((row.doc_id, tuple(np.frombuffer(row.ids, "<u4").tolist())) for row in found) == want
    found.sort(key=lambda row: row.start)
    assert [row.start for row in found] == [0, *np.cumsum([row.n_tokens for row in found])[:-1]]
    assert [row.doc_id for row in found] == sorted([row.doc_id for row in found], key=lambda x: (x is not None, x))


def test_no_token_files(spark, no_docs, token_file):
    assert tokens.read_tokens(spark, tokens.write_tokens(no_docs, token_file)).count() == 0


# --- personal data

PRIVATE = {
    "write to ann.lee@mail.example.com now": r"^write to [a-z]{3}\.[a-z]{3}@[a-z]{4}\.[a-z]{7}\.com now$",
    "call +1 (269) 555-3296.": r"^call \+1 \(\d{3}\) \d{3}-\d{4}\.$",
    "4111 1111 1111 1111 28.68.191.238": r"^4\d{3} \d{4} \d{4} \d{4} \d+\.\d+\.\d+\.\d+$",
    "4111111111111111 27.65.93.188": r"^4\d{15} \d+\.\d+\.\d+\.\d+$",
    "DE89 3704 0044 0532 0130 00": r"^DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d$",
    "on 1984-02-29": r"^on \d{4}-\d\d-\d\d$",
    "ssn 123-45-6789": r"^ssn \d{3}-\d\d-\d{4}$",
}
CLEAN = ["4111 1111 1111 1112", "on 1983-02-29", "666-45-6789", "999.1.1.1", "version 2.0 of 2004", "", None, "x @ y"]


def _luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_the_format(spark):
    texts = [*PRIVATE, *CLEAN]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {row.text: row for row in pii.pseudonymise(rows, "key").collect()}
    for text, pattern in PRIVATE.items():
        new = found[text].pseudonymised
        assert new != text and re.match(pattern, new) and found[text].found >= 1
    for text in CLEAN:
        assert found[text].pseudonymised == text and found[text].found == 0
    cards = re.findall(r"\d", found["4111111111111111 27.65.93.188"].pseudonymised[:16])
    assert _luhn(cards)
    assert "".join(cards) == found["4111 1111 1111 1111 28.68.191.238"].pseudonymised[:19].replace(" ", ""), "equal values stay equal"


def test_pseudonyms_keep_columns_of_any_name(spark, no_docs, odd_docs):
    rows = [("call +1 (269) 555-3296.", 1, 2, 3), (None, 4, 5, 6), ("", 7, 8, 9), ("x" * 200_000, 10, 11, 12)] * 2
    named = spark.createDataFrame(rows, "text string, _values int, _values_ int, _Rebuilt int")
    found = pii.pseudonymise(named, "key")
    assert found.columns == [*named.columns, "pseudonymised", "found"]
    assert sorted(tuple(row)[1:4] for row in found.collect()) == sorted(row[1:] for row in rows)
    assert {row.text: row.found for row in found.collect() if row.found} == {"call +1 (269) 555-3296.": 1}
    assert pii.pseudonymise(no_docs, "key").count() == 0 and pii.pseudonymise(odd_docs, "key").count() == odd_docs.count()


def test_the_key_stands_in_no_plan(spark):
    rows = spark.createDataFrame([("call +1 (269) 555-3296.",)], "text string")
    found = pii.pseudonymise(rows, "open-sesame")
    assert found.first().pseudonymised != pii.pseudonymise(rows, "other").first().pseudonymised
    plan = found._jdf.queryExecution()
    for shown in (plan.toString(), plan.executedPlan().toString()):
        assert "open-sesame" not in shown
    assert "Python" not in plan.executedPlan().toString()


def test_values_end_where_they_end(spark):
    texts = {
        "ES91 2100 0418 4502 0005 1332 BIC CAIXESBB": r"^ES\d\d \d{4} \d{4} \d{4} \d{4} \d{4} BIC CAIXESBB$",
        "BE68 5390 0754 7034 2024": r"^BE\d\d \d{4} \d{4} \d{4} 2024$",
        "pay PL61109010140000071219812874 2024 now": r"^pay PL\d{26} 2024 now$",
        "DE12 DE89 3704 0044 0532 0130 00": r"^DE12 DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d$",
        "2024 4111 1111 1111 1111 ok": r"^2024 4\d{3} \d{4} \d{4} \d{4} ok$",
        "BE12 4111 1111 1111 1111": r"^BE12 4\d{3} \d{4} \d{4} \d{4}$",
    }
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    for row in pii.pseudonymise(rows, "key").collect():
        assert row.found == 1 and row.pseudonymised != row.text and re.match(texts[row.text], row.pseudonymised), row


def test_permutations_are_one_to_one(spark):
    rows = spark.range(35).select(pii.permute_number(F.col("id"), (7, 5), F.lit("k"), "test").alias("x"))
    assert sorted(row.x for row in rows.collect()) == list(range(35))
    texts = spark.range(1000).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("k"), "t").alias("x"))
    assert len({row.x for row in texts.collect()}) == 1000


# --- benchmark passages


def test_benchmark_passages(spark, docs, tables):
    items = spark.read.parquet(os.path.join(tables, "benchmark.parquet"))
    found = decontaminate.contaminated(docs, items).select("doc_id", "items").collect()
    flat = {row.item_id: f" {' '.join(decontaminate.words_of(row.text))} " for row in items.collect()}
    texts = {row.doc_id: f" {' '.join(decontaminate.words_of(row.text))} " for row in docs.collect()}
    want = {(doc, item) for doc, text in texts.items() for item, words in flat.items() if words in text}
    assert want and {(row.doc_id, hit.item_id) for row in found for hit in row["items"]} == want


def test_bounds_lose_no_candidate(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 200)))) for i in range(40)]
    index = next(decontaminate.indexes(spark.createDataFrame(items, "item_id int, text string"))).value
    gains = collections.defaultdict(dict)
    for term, number in index.terms.items():
        for at in range(index.starts[number], index.starts[number + 1]):
            gains[int(index.units[at])][term] = float(index.gains[at])
    for _ in range(30):
        words = rng.choices([*vocabulary, "other"], k=rng.randrange(0, 400))
        want = {}
        step, size = decontaminate.STRIDE_WORDS, decontaminate.PASSAGE_WORDS
        for first in range(0, max(1, len(words) - size + step), step):
            passage = set(words[first : first + size])
            for unit, terms in gains.items():
                score = sum(gain for term, gain in terms.items() if term in passage)
                if score >= decontaminate.THRESHOLD:
                    item = int(index.items[unit])
                    want[item] = max(want.get(item, 0.0), score)
        got = index.candidates([[index.terms.get(word, -1) for word in words]])[0]
        assert got.keys() == want.keys()
        assert all(abs(got[item] - want[item]) < 1e-9 for item in want)


def test_odd_benchmarks(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a text without an id"), (None, "!")], "item_id bigint, text string")
    found = {(row.doc_id, row.text): len(row["items"]) for row in decontaminate.contaminated(odd_docs, items).collect()}
    assert found[None, "a text without an id"] == 1 and sum(found.values()) == 1
    assert sum(len(row["items"]) for row in decontaminate.contaminated(odd_docs, items.limit(0)).collect()) == 0
    assert decontaminate.contaminated(no_docs, items).count() == 0


def test_several_indexes_find_what_one_finds(spark, docs, tables):
    items = spark.read.parquet(os.path.join(tables, "benchmark.parquet"))
    assert len(list(decontaminate.indexes(items, postings_per_index=300))) > 3

    def found(**options):
        rows = decontaminate.contaminated(docs.repartition(3), items, **options).collect()
        return {(row.doc_id, hit.item_id, round(hit.score, 9)) for row in rows for hit in row["items"]}

    assert found(postings_per_index=300) == found() != set()


def test_ids_of_items_keep_their_type(spark):
    rows = spark.createDataFrame([(1, "one two three four five six seven")], "doc_id int, text string")
    items = spark.createDataFrame([("a-1", "one two three four five six"), (None, "two three four five six seven")], "id string, text string")
    (row,) = decontaminate.contaminated(rows, items, id_col="id").collect()
    assert {hit.item_id for hit in row["items"]} == {"a-1", None}
    empty = decontaminate.contaminated(rows, items.limit(0), id_col="id")
    assert empty.schema["items"].dataType.elementType["item_id"].dataType.simpleString() == "string" and empty.first()["items"] == []


def test_memory_of_long_items_is_bounded(spark):
    """Common words in every item: what a step holds follows its postings, not passages times blocks."""
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(20_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=200))) for i in range(3000)]
    index = next(decontaminate.indexes(spark.createDataFrame(items, "item_id int, text string"))).value
    texts = [" ".join(rng.choices(vocabulary, k=400)).encode() for _ in range(300)] + [items[5][1].encode()]
    tracemalloc.start()
    hits = index.hits(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [hit["item_id"] for hit in hits[-1]] == [5] and peak < 400 << 20, peak


def test_short_items(spark):
    items = [(1, "Capital of France? Paris"), (2, "法国的首都是哪里？巴黎"), (3, "Colour? Red"), (4, "Anagrams")]
    texts = [
        "we ask: Capital of France? Paris is the answer to it",
        "paris france of capital and more words here",
        "前言，法国的首都是哪里？巴黎。后记，还有别的话，更多，再多",
        "colour red anagrams",
        "red is a colour like any other one",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(rows, benchmark).orderBy("doc_id").collect()
    assert [{hit.item_id for hit in row["items"]} for row in found] == [{1}, set(), {2}, {3, 4}, set()]


# --- language


def test_language_on_held_out_documents(spark, docs, odd_docs):
    model = queries.language_model(docs)
    found = langid.identify(docs, model).filter(langid.held_out(F.col("doc_id"), 4, 2)).select("lang", "identified.*").collect()
    assert np.mean([row.lang == row.language for row in found]) > 0.95 and not any(row.rejected for row in found)
    noise = spark.createDataFrame([(" ".join("".join(random.Random(i).choices("qxzjvkwpfb", k=9)) for i in range(80)),)], "text string")
    assert langid.identify(noise, model).first().identified.rejected
    odd = {(row.doc_id, row.text): row.identified for row in langid.identify(odd_docs, model).collect()}
    assert odd[3, None].language == odd[4, ""].language == odd[7, "12 + 34 = 46 ! ?"].language == langid.UNKNOWN
    assert all(0 <= row.score <= 1 for row in odd.values())


def test_probabilities_add_up(spark):
    rows = spark.createDataFrame([("abba cab", "x"), ("bead", "x"), ("zzz", "y"), (None, "x"), ("q", None)], "text string, lang string")
    model = langid.fit(rows)
    alphabet = [*"abcdez", langid.END, "?"]
    for context in ("\x02\x02\x02\x02", "\x02abb", "\x02\x02ca", "zzzz"):
        codes = np.array([[ord(c) for c in context + letter] for letter in alphabet], "<u4")
        # "?" stands for every character not seen.
        assert np.allclose(np.exp(model.log_probabilities(codes)).sum(axis=0), 1, atol=1e-5)


def test_every_sequence_is_kept_and_joins_agree(spark):
    rng = random.Random(6)
    words = ["".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(60)) for _ in range(3600)]
    rows = [(" ".join(words[i : i + 20]), "x") for i in range(0, len(words), 20)]
    rows += [("abba cab bead", "y"), ("zzz bead", "y"), ("12", "y"), (None, "x"), ("q", None)]
    table = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    sent, stored = langid.fit(table), langid.fit(table, sent_entries=0)
    assert len(sent.grams[0][langid.ORDER - 1][0]) > 200_000
    assert isinstance(stored, langid.StoredModel) and stored.limits == pytest.approx(sent.limits)
    texts = [("abba", 1), ("abba", 1), ("zzz cab " + words[0], 2), ("12", 3), (None, 4), ("unseen \u00e9t\u00e9", 5)]
    asked = spark.createDataFrame(texts, "text string, doc_id int")

    def found(model):
        frame = langid.identify(asked, model)
        assert frame.columns == ["text", "doc_id", "identified"]
        rows = frame.orderBy("doc_id").collect()
        return [(r.doc_id, r.text, r.identified.language, r.identified.rejected) for r in rows], [
            (r.identified.score, r.identified.cross_entropy or 0.0) for r in rows
        ]

    (one, numbers), (other, others) = found(sent), found(stored)
    assert one == other and np.allclose(numbers, others, atol=1e-9)


def test_every_language_has_a_limit(spark):
    rng = random.Random(8)
    rows = [(" ".join(rng.choices(["abba", "cab", "bead", "deaf"], k=6)) + " " + "abcdef"[i % 6] * (i % 9), "x") for i in range(20_000)]
    rows += [("zzz yyy zyz", "y"), ("uvw wvu uuu", "w"), ("kkl lkl kll", "k")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(model.limits) == ["k", "w", "x", "y"]


def test_no_language(spark, no_docs, odd_docs):
    model = langid.fit(no_docs)
    assert {row.identified.language for row in langid.identify(odd_docs, model).collect()} == {langid.UNKNOWN}
    assert langid.identify(no_docs, model).count() == 0


# --- repeated passages


def test_numbers_are_no_letters(spark, docs):
    """Neither way of scoring takes them for words; clashing names do no harm."""
    texts = ["½ ² ① Ⅷ ٣ 12 _", "½ the ²", "", None, "x" * 100_000, "the of and"]
    rows = spark.createDataFrame([(i, text, "j", 1, "k") for i, text in enumerate(texts)], "doc_id int, text string, _judged string, _row int, _key string")
    labelled = docs.filter("lang is not null").limit(60)
    for entries in (langid.SENT_ENTRIES, 0):
        model = langid.fit(labelled, sent_entries=entries)
        found = langid.identify(rows, model)
        assert found.columns == [*rows.columns, "identified"] and found.count() == len(texts)
        languages = {row.doc_id: row.identified.language for row in found.collect()}
        assert sorted(i for i, language in languages.items() if language == "und") == [0, 2, 3]
        assert langid.identify(rows.limit(0), model).count() == 0


def test_one_pass_equals_two(docs, odd_docs, no_docs):
    held_out = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.filter(~held_out).select("text", "lang"))
    two = {row.doc_id: tuple(row.identified) for row in langid.identify(docs.select("doc_id", "text"), model).collect()}
    one = langid.fit_and_identify(docs.select("doc_id", "text", "lang"), ~held_out)
    assert one.columns == ["doc_id", "lang", "identified"]
    assert {row.doc_id: tuple(row.identified) for row in one.collect()} == two
    odd = langid.fit_and_identify(odd_docs.withColumnsRenamed({"anchor": "row", "rank": "found"}), F.col("doc_id") < 7)
    assert odd.count() == odd_docs.count() and "row" in odd.columns
    assert langid.fit_and_identify(no_docs, F.lit(True)).count() == 0


def _kneser_ney(texts, alphabet):
    """Probability of a character after the ones before, worked out from plain counts."""
    pad, end, order = langid.PAD, langid.END, langid.ORDER
    grams = [collections.Counter() for _ in range(order + 1)]
    for text in texts:
        for word in langid.words_of(text.encode()):
            padded = pad * (order - 1) + word + end
            for i in range(len(word) + 1):
                grams[order][padded[i : i + order]] += 1
    for k in range(order - 1, 0, -1):
        for longer, n in grams[k + 1].items():
            grams[k][longer[1:]] += n if longer[1] == pad else 1

    def probability(sequence):
        if not sequence:
            return 1 / alphabet
        counts = grams[len(sequence)]
        ones, twos = (sum(n == x for n in counts.values()) for x in (1, 2))
        discount = min(0.95, ones / (ones + 2 * twos)) if ones and twos else 0.5
        same = [n for gram, n in counts.items() if gram[:-1] == sequence[:-1]]
        below = probability(sequence[1:])
        if not same:
            return below
        n = counts.get(sequence, 0)
        return (n - min(discount, n)) / sum(same) + discount * len(same) / sum(same) * below

    return probability


def test_model_equals_plain_kneser_ney(spark):
    texts = ["the cat sat on the mat", "that hat the cat", "a rat"]
    rows = spark.createDataFrame([(text, "en") for text in texts], "text string, lang string")
    model = langid.fit(rows)
    letters = {char for text in texts for word in text.split() for char in word} | {langid.END}
    plainly = _kneser_ney(texts, len(letters) + 1)
    sequences = ["\x02\x02\x02\x02t", "\x02\x02\x02th", "\x02\x02the", "\x02the\x03", "that\x03", "xxcat", "zzzzz", "cat\x03"[-5:].rjust(5, "q")]
    codes = np.array([[ord(char) for char in sequence] for sequence in sequences])
    found = np.exp(model.log_probabilities(codes)[:, 0])
    assert np.allclose(found, [plainly(sequence) for sequence in sequences], rtol=1e-5)


def _strip(texts, window):
    words = [(text or "").encode().split() for text in texts]
    counts = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("crowd", [1, 1500])
def test_repeated_passages(spark, crowd):
    rng = random.Random(2)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randrange(3, 30))) for _ in range(6)]
    texts = ["\n".join(rng.choice([*passages, "x" * rng.randrange(1, 5), "y \t z"]) for _ in range(rng.randrange(8))) for _ in range(120)]
    texts += ["p q " * 40, None, "", "p " * 8, "p " * 9]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    found = phrases.remove_repeats(rows, window_words=8, anchor_words=3, segments_at_once=crowd).orderBy("doc_id").collect()
    assert [(row.n_words, row.n_removed, row.kept) for row in found] == _strip(texts, 8)


def test_words_that_differ_are_not_repeated(spark):
    """Words that polynomial hashes modulo 2^64 take for equal."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"z{i}" for i in range(34))
    mixed = ["u", "v"]
    sentence = " ".join(mixed[bin(i).count("1") % 2] for i in range(62))
    swapped = " ".join(mixed[1 - bin(i).count("1") % 2] for i in range(62))
    texts = [f"{one} {rest}", f"{other} {rest}", f"{sentence} end", f"{swapped} end", "a  b " * 20, "a\nb\t" * 20]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row.doc_id: row.n_removed for row in phrases.remove_repeats(rows).collect()}
    assert found == {i: gone for i, (_, gone, _) in enumerate(_strip(texts, 35))}
    assert found[0] == found[1] == 0 and found[4] == 40


def test_spans_of_equal_rows_do_not_add_up(spark):
    text = " ".join(f"w{i}" for i in range(120))
    for n in (2, 200):
        rows = spark.createDataFrame([(7, text)] * n, "doc_id bigint, text string")
        source = rows.select(F.col("doc_id").alias("id"), F.lit(1).cast("bigint").alias("key"), F.col("text").cast("binary").alias("text"))
        spans = phrases.repeated_passages(source).collect()
        assert len(spans) == 1 and len(spans[0].spans) < 30
        assert phrases.remove_repeats(rows).filter("n_removed = 120").count() == n


def test_repeated_passages_of_odd_rows(odd_docs, no_docs):
    found = collections.Counter((row.doc_id, row.n_words, row.n_removed) for row in phrases.remove_repeats(odd_docs).collect())
    assert found[2, 60, 60] == 2 and found[1, 60, 60] == 1 and found[6, 30_000, 0] == 1 and found[None, 0, 0] == 1
    assert phrases.remove_repeats(no_docs).count() == 0


# --- SimHash


def _fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(gram, 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(prints, distance):
    """Smallest id of each group of (id, fingerprint)."""
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[root(i)] = min(x for x in (least.get(root(i)), doc) if x is not None) if doc is not None or root(i) in least else None
    return [least[root(i)] for i in range(len(prints))]


def test_near_duplicates(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [(row.doc_id, _fingerprint(row.text)) for row in rows]
    found = {row.doc_id: (row.fingerprint % (1 << 64), row.component_id) for row in simhash.near_duplicates(docs).collect()}
    want = dict(zip([doc for doc, _ in prints], zip([p for _, p in prints], _components(prints, 2), strict=True), strict=True))
    assert found == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_anchors_lose_no_link(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(20)]
    near = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for x in base for _ in range(12)]
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in base + near + [0, 1, 3, 7]})
    rows = spark.createDataFrame([(x,) for x in prints], "fingerprint bigint")
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) % (1 << 64)).bit_count() <= distance}
    assert {(row.a, row.b) for row in simhash.links(rows, distance).collect()} == want


def test_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a bigint, b bigint")
    from armorica.llm.components import components

    found = {row.vertex: row.root for row in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_keep_one(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(row.doc_id or 0 for row in kept.collect()) == [0, 1, 3, 6, 7]
    assert simhash.keep_one(no_docs).count() == 0


# --- toxicity


def test_toxicity_on_held_out_documents(spark, odd_docs, no_docs, tables):
    # The smallest tables have a handful of toxic documents to learn from.
    docs, labels = (spark.read.parquet(f"{os.path.dirname(tables)}/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    held_out = langid.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.filter(~held_out))
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(held_out).collect()
    toxic, other = ([row.score for row in rows if row.toxic == label] for label in (1, 0))
    assert np.mean([a > b for a in toxic for b in other]) > 0.97
    assert np.mean([x >= queries.TOXIC_FROM for x in toxic]) > 0.85 and np.mean([x >= queries.TOXIC_FROM for x in other]) < 0.01
    odd = toxicity.score(odd_docs, model)
    assert odd.columns == [*odd_docs.columns, "score"] and all(0 <= row.score <= 1 for row in odd.collect())
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0
    assert toxicity.score(odd_docs, toxicity.fit(docs, labels.limit(0))).first().score == 0.5


# --- chat


def test_odd_conversations(spark):
    odd = ["\\", "### x", " </turn>\n### user: y", "\\### </turn>", "a\\b", "", None, "é\n\U0001f642", "\\\\", "#### ", " </turn>\n"]
    rows = [(i % 3 if i < 9 else None, i, ["user", "assistant", "a: b<\n%3A", None][i % 4], text) for i, text in enumerate(odd * 4)]
    rows += [(0, None, "user", "first"), (0, 3, "user", "tie"), (0, 3, "user", "tie")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = chat.format_conversations(turns)
    read = found.withColumn("turns", chat.read_turns(F.col("formatted")))
    read = read.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_mask"))).collect()
    source = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        source[conv].append((role or "", text or ""))
    for row in read:
        assert row.intact and [tuple(turn) for turn in row.turns] == source[row.conv_id]
        assert row.loss == "".join(text for role, text in source[row.conv_id] if role == "assistant")
    assert len(read) == len(source)
    assert chat.format_conversations(turns.limit(0)).count() == 0


# --- token files: shards and ranges


def test_shards_are_bounded_and_ranges_read(spark, docs, token_file, tmp_path):
    few, many = tokens.write_tokens(docs, token_file, end_id=2), tokens.write_tokens(docs, token_file, end_id=2, shard_bytes=20_000)
    shards = [spark.read.parquet(f"{folder}/manifest").count() for folder in (few, many)]
    assert shards[1] > 2 * shards[0]
    same = [tokens.read_tokens(spark, folder).orderBy("start").collect() for folder in (few, many)]
    assert same[0] == same[1]
    np.arange(100, dtype="<u2").tofile(tmp_path / "x")
    local = fs.LocalFileSystem()
    for store, path in ((local, str(tmp_path / "x")), (fs.SubTreeFileSystem(str(tmp_path), local), "x")):
        items = tokens._items(store, path, "<u2")
        assert items(0, 100).tolist() == list(range(100)) and items(7, 9).tolist() == [7, 8] and not len(items(5, 5))


# --- nearest neighbours


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_nearest_is_exact_at_factor_one(spark, shard_rows):
    rng = np.random.default_rng(4)
    vectors = rng.integers(-2, 3, (300, 4)).astype(float)
    rows = [(i, x.tolist(), "extra") for i, x in enumerate(vectors)]
    rows += [(900, None, ""), (920, [0.0] * 4, ""), (940, [1.0, None, 1.0, 1.0], ""), (960, [float("nan")] * 4, ""), (None, [1.0] * 4, "")]
    rows += [(980, [1.0, 2.0], ""), (981, [3.0, 1.0], "")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    found = collections.defaultdict(list)
    for row in vptree.nearest(table, lambda i: i % 20 == 0, 7, shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        found[row.query_id].append((row.id, row.score))
    real = [i for i, x in enumerate(vectors) if x.any()]
    for q in [i for i in real if i % 20 == 0]:
        scores = sorted(((-float(vectors[q] @ vectors[c]), c) for c in real if c != q))[:7]
        assert found.pop(q) == [(c, -s) for s, c in scores]
    assert dict(found) == {980: [(981, 5.0)]}
    assert vptree.nearest(table.limit(0), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("shard_rows", [16, 4096])
def test_nearest_takes_repeated_ids_as_rows(spark, shard_rows):
    rng = np.random.default_rng(5)
    # A third of the rows are one vector, of one id or of several.
    rows = [(i % 40, x.tolist()) for i, x in enumerate(rng.integers(-2, 3, (200, 3)).astype(float)) if x.any()]
    rows += [(i % 7 * 20, [1.0, 2.0, 1.0]) for i in range(100)]
    found = vptree.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda i: i % 20 == 0, 5, shard_rows=shard_rows)
    expected = []
    for q, (query_id, x) in enumerate(rows):
        if query_id % 20 == 0:
            scores = sorted((-float(np.dot(x, y)), c) for r, (c, y) in enumerate(rows) if r != q)[:5]
            expected += [(query_id, rank, c, -s) for rank, (s, c) in enumerate(scores, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_regions_far_away_are_not_searched():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(16, 8))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = np.repeat(centres, 100, axis=0) + rng.normal(scale=0.02, size=(1600, 8))
    most = (vectors**2).sum(axis=1).max()
    router = vptree.build_router(vectors[::4], most, 25)
    home = vptree.route(router, vectors)
    spans = {region: vptree._spans(router, region, vectors[home == region]) for region in set(home.tolist())}
    products = vectors @ vectors.T
    floor = np.sort(np.where(home[:, None] == home, products, -np.inf), axis=1)[:, -10]
    visited = 0
    for q in range(0, 1600, 20):
        wanted = vptree.regions_to_search(router, spans, home[q : q + 1], vectors[q : q + 1], floor[q : q + 1], 1.0)
        better = set(home[products[q] >= floor[q]].tolist()) - {home[q]}
        assert better <= set(wanted)
        visited += len(wanted)
    assert visited < 0.3 * 80 * len(spans)


def test_relaxed_search_recalls(spark, tables):
    table = spark.read.parquet(os.path.join(tables, "embeddings.parquet"))
    exact, relaxed = (
        {(row.query_id, row.id) for row in vptree.nearest(table, lambda i: i % 20 == 0, factor=factor).collect()} for factor in (1.0, 1.3)
    )
    assert len(exact & relaxed) / len(exact) >= 0.9


# --- mixing


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    left = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, target = share * sum(sizes.values()), {}
    while left:
        level = total / sum(left.values())
        full = [s for s, w in left.items() if level * w >= most * sizes[s]]
        if not full:
            return target | {s: level * w for s, w in left.items()}
        for s in full:
            target[s] = most * sizes[s]
            total -= target[s]
            del left[s]
    return target


def test_mix_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect())), "reruns agree"
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for row in rows:
        sizes[row.source] += row.size
        taken[row.source] += row.taken
        target[row.source] = row.target
        assert row.taken == row.size * row.whole + sum(part["words"] for part in row.parts) <= 2 * row.size
    want = _targets(sizes)
    for source in sizes:
        assert abs(target[source] - want[source]) < 1e-6 * want[source]
        assert abs(taken[source] - want[source]) < 0.02 * want[source]


def test_mix_meets_targets_of_rare_sources(spark):
    rows = [(i, "a b c d e f g h i j", "hot") for i in range(20_000)]
    rows += [(50_000 + i, "a b c d e f g h i j", "rare") for i in range(10)] + [(60_000, "k l m n o p q r s t", "single")]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    taken, target = collections.Counter(), {row.source: row.target for row in mixed}
    for row in mixed:
        taken[row.source] += row.taken
    assert len(target) == 3
    for source in target:
        assert abs(taken[source] - target[source]) <= max(1, 0.02 * target[source])


def test_equal_rows_are_dealt_to_shards(spark):
    """Equal rows, a third of all, are one row with a number of copies in each of several shards."""
    rows = [(1, "a b c", "s")] * 5000 + [(i, f"d{i} e f g h", "s") for i in range(2, 6000)] + [(None, None, None)] * 300 + [(1, "a b c", "t")] * 7
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    mixed = mixing.mix(docs, docs_per_shard=512).collect()
    again = mixing.mix(docs.repartition(5), docs_per_shard=512).collect()
    assert sorted(map(tuple, mixed), key=repr) == sorted(map(tuple, again), key=repr), "reruns agree"
    number = collections.Counter((row.doc_id, row.size, row.source) for row in mixed)
    assert number == collections.Counter((i, len((text or "").split()), source) for i, text, source in rows)
    taken = collections.Counter()
    for row in mixed:
        taken[row.source] += row.taken
        assert row.taken == row.size * row.whole + sum(part["words"] for part in row.parts) <= 2 * row.size
    want = _targets({"s": 5000 * 3 + 5998 * 5, "t": 21, None: 0})
    assert all(abs(taken[source] - want[source]) <= max(3, 0.02 * want[source]) for source in want)
    pieces = mixing.mixture(docs, docs_per_shard=512).collect()
    assert sum(len((row.text or "").split()) for row in pieces) == sum(taken.values())


def test_apportionment(spark):
    rng = random.Random(8)
    shares = {i: rng.choice([0.1, 1.0, 5.0, 90.0, 400.0]) for i in range(25)}
    rows = spark.createDataFrame(list(shares.items()), "id int, share double")
    for seats in (0, 1, 7, 100, 5000):
        found = {row.id: row.quota for row in mixing.apportion(rows, [], F.lit(seats), [F.col("id")]).collect()}
        quotients = sorted((-share / (2 * k + 1), i, k) for i, share in shares.items() for k in range(seats))[:seats]
        assert found == {i: sum(1 for _, j, _ in quotients if j == i) for i in shares}


def test_targets_of_many_sources(spark):
    rng = random.Random(9)
    sizes = {f"site-{i}": rng.choice([0, 5, 5, 40, 3000]) for i in range(3000)} | {None: 17, "": 100_000}
    sources = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {row.source: row.target for row in mixing.targets(sources).collect()}
    want = _targets(sizes)
    assert found.keys() == want.keys()
    assert all(abs(found[source] - want[source]) <= 1e-9 * max(1, want[source]) for source in want)
    planned = mixing.targets(sources).select("rank", F.col("target").alias("share")).filter("share > 0")
    quotas = mixing.apportion(planned, [], F.lit(5000), [F.col("rank")])
    assert "windowspecdefinition(" not in quotas._jdf.queryExecution().analyzed().toString().replace("windowspecdefinition(_range", "")
    assert quotas.agg(F.sum("quota")).first()[0] == 5000


def test_mixture_holds_what_is_taken(odd_docs, no_docs):
    mixed = mixing.mixture(odd_docs, share=0.9)
    assert mixed.columns == odd_docs.columns
    number = sum(len((row.text or "").split()) for row in mixed.collect())
    assert number == sum(row.taken for row in mixing.mix(odd_docs, share=0.9).collect()) > 0
    assert mixing.mixture(no_docs).count() == 0
