import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import bin_completion as bins
from tideline.llm import token_packing as packing


def ids_of(text):
    return packing._tokenizer(packing.TOKENIZER).encode(text or "", add_special_tokens=False).ids


def fewest(sizes, capacity):
    """Least number of bins, by trying all ways to place the items one after the other."""
    best = len(sizes)

    def place(at, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if at == len(sizes):
            best = len(spaces)
            return
        for i, space in enumerate(spaces):
            if space >= sizes[at] and space not in spaces[:i]:
                place(at + 1, [*spaces[:i], space - sizes[at], *spaces[i + 1 :]])
        place(at + 1, [*spaces, capacity - sizes[at]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def check_plan(plan, counts, capacity):
    used = Counter()
    for filling, n in plan:
        assert n > 0 and sum(s * k for s, k in filling) <= capacity
        for s, k in filling:
            used[s] += n * k
    assert used == Counter({s: n for s, n in counts.items() if n})
    return sum(n for _, n in plan)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_plans_are_optimal_on_small_cases(sizes):
    counts = Counter(sizes)
    assert check_plan(bins.best_fit(counts, 20), counts, 20) >= fewest(sizes, 20)
    best = check_plan(bins.complete(counts, 20, width=50, items=9), counts, 20)
    assert best == fewest(sizes, 20) >= bins.lower_bound(counts, 20)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(0, 500), max_size=40))
def test_plans_hold_all_items_and_are_no_worse_than_best_fit(counts):
    plain = check_plan(bins.best_fit(counts, 100), counts, 100)
    best = check_plan(bins.complete(counts, 100, steps=3000), counts, 100)
    assert bins.lower_bound(counts, 100) <= best <= plain


def test_bin_completion_beats_best_fit():
    counts = Counter([6, 5, 5, 4, 3, 3, 2, 2])  # best-fit decreasing needs four bins of ten
    assert check_plan(bins.complete(counts, 10), counts, 10) == 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_only_the_steps_bound_the_search(sizes):
    counts = Counter(sizes)
    assert check_plan(bins.complete(counts, 20), counts, 20) == fewest(sizes, 20)


def test_short_documents_are_packed_better_than_by_best_fit():
    rng = random.Random(5)
    counts = Counter(rng.randint(300, 500) for _ in range(600))  # five or six to a bin
    plain = check_plan(bins.best_fit(counts, 2048), counts, 2048)
    least = bins.lower_bound(counts, 2048)
    assert check_plan(bins.complete(counts, 2048), counts, 2048) - least < (plain - least) / 2


def test_sizes_must_fit():
    with pytest.raises(ValueError):
        bins.complete({11: 1}, 10)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abÉßé'sll,.!-12 \n\t\x1c\xa0ΣİK漢é<|>²\x00"), max_size=60))
def test_word_ids_are_the_tokenizers(text):
    encode = packing.WordIds(packing.TOKENIZER)
    for _ in range(2):
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 3)
    encode, rng = packing.WordIds(packing.TOKENIZER), random.Random(3)
    for _ in range(50):
        text = " ".join(rng.choice(["the", "cat,", "x" * 90, "It's", "é"]) + str(rng.randrange(9)) for _ in range(9))
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)


def test_pieces_and_places(spark):
    rng = random.Random(9)
    words = ["the", "a", "cat", "sat", "onomatopoeia", "Zürich"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 40, 41, 300])))) for i in range(120)]
    rows += [(500, None), (501, ""), (7, rows[7][1]), (7, rows[7][1]), (None, "the cat"), (900, "cat " * 63)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"length": F.lit("x"), "piece": F.lit(1), "_key": F.lit(2)}
    )
    full = packing.token_pieces(docs, capacity=64, with_ids=True)
    packed = packing.pack(full, 64)
    got = packed.collect()
    want = []
    for doc_id, text in rows:
        ids = [*ids_of(text), 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want.append((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= bins.lower_bound(Counter(len(w[-1]) for w in want), 64) + 1
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert {k: len(r.ids) for k, r in whole.items()} == {k: sum(n for _, n in p) for k, p in places.items()}


def test_many_buckets_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 2)
    docs = spark.createDataFrame([(i, "a b") for i in range(40)] + [(50, "c")], "doc_id long, text string")
    got = packing.pack_documents(docs, capacity=7).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 41 and len({r.sequence_id for r in got}) == 21
    assert packing.pack_documents(docs.limit(0)).collect() == []
