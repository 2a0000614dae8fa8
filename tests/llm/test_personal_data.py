import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import personal_data as pii
from tideline.llm.char_tagger import Tagger
from tideline.llm.tables import hashed_sample

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), i, m.end())
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé@..+-- ()0123456789%٣"), max_size=60))
def test_base_spans_are_the_patterns_matches(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "@", "1.2.3.4", ".5.6.256.8", "4111 1111 1111 1111", "+1 (017) 555-7713",
                                 "+1", "9", " ", "x@y", ".z", "-", "00001.2.3.4", "漢"]), max_size=12).map("".join))
def test_base_spans_of_joined_pieces(text):
    assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "1 " * 99_999 + "@"])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    tagger = Tagger(3, embed=3, hidden=4)
    windows, gold = rng.integers(0, 6, (5, 7)), rng.integers(0, 3, (5, 7))
    _, grads = tagger._loss(windows, gold)
    for name, values in tagger.w.items():
        for at in rng.integers(0, values.size, 4):
            spot = np.unravel_index(at, values.shape)
            values[spot] += 1e-5
            up = tagger._loss(windows, gold)[0]
            values[spot] -= 2e-5
            down = tagger._loss(windows, gold)[0]
            values[spot] += 1e-5
            assert abs((up - down) / 2e-5 - grads[name][spot]) < 1e-5


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/documents.parquet")
    return pii.train(docs.where("doc_id % 2 = 0")), docs.where("doc_id % 2 = 1 and text rlike '[0-9@]'")


def test_model_finds_held_out_spans(trained):
    tagger, held_out = trained
    texts = [r.text for r in held_out.select("text").collect()]
    base = [set(pii.base_spans(t)) for t in texts]
    model = [set(s) for s in pii.model_spans(texts, tagger)]
    hits = sum(len(b & m) for b, m in zip(base, model))
    recall, precision = hits / sum(map(len, base)), hits / sum(map(len, model))
    assert recall > 0.8 and precision > 0.6
    extra = sum(len(a) for _, a in pii.all_spans(texts, tagger))
    assert extra <= 0.02 * sum(map(len, base))


def test_trained_model_adds_held_out_forms(trained):
    """Spans of held-out texts, written as the patterns do not find them, are added."""
    tagger, held_out = trained
    plain = [r.text for r in held_out.select("text").collect()]
    pairs = [pii.varied_text(t, pii.base_spans(t)) for t in plain]
    found = [set(base + added) for base, added in pii.all_spans([t for t, _ in pairs], tagger)]
    by = {}
    for (text, spans), got in zip(pairs, found):
        for span in spans:
            assert span not in pii.base_spans(text)
            by.setdefault(span[1], []).append(span in got)
    shares = {pii.KINDS[k]: (sum(v) / len(v), len(v)) for k, v in by.items()}
    assert sum(map(sum, by.values())) >= 0.9 * sum(map(len, by.values())), shares
    wrong = sum(len(got - set(spans) - set(pii.base_spans(text))) for (text, spans), got in zip(pairs, found))
    print("held-out forms found", shares, "wrong", wrong)
    assert wrong <= 0.02 * sum(map(len, by.values()))


@pytest.mark.parametrize("kind, text", [(0, "a@b.co"), (0, "joe.x@mail.firm.org"), (1, "10.0.0.1"), (2, "4111 1111 1111 1111"), (3, "+1 (017) 555-7713")])
def test_varied_forms_still_look_like_their_kind(kind, text):
    for pick in range(40):
        form = pii.varied(kind, text, pick)
        assert (0, kind, len(form)) not in pii.base_spans(form) and pii._looks_right(kind, form), form


def test_training_windows_do_not_depend_on_partitions(spark):
    docs = spark.range(3000).select(F.concat(F.lit("mail a"), F.col("id"), F.lit("@b.co or call "), F.hash("id")).alias("text"))
    one = {tuple(map(bytes, r)) for r in pii.training_windows(docs, sample=128).collect()}
    assert one == {tuple(map(bytes, r)) for r in pii.training_windows(docs.repartition(9), sample=128).collect()}
    assert 32 <= len(one) <= 128


def test_detect_keeps_base_spans(spark, trained):
    long = "word " * 30_000 + "a@b.co " + "7" * 5000 + " 10.0.0.1"
    rows = [(1, "mail a@b.co or +1 (017) 555-7713\n"), (2, None), (3, ""), (None, "10.0.0.1"), (5, long), (5, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "d": F.lit(2)})
    for tagger in (trained[0], None):
        for row, (doc_id, text) in zip(pii.detect(docs, tagger).collect(), rows):
            base = brute(text)
            assert row.doc_id == doc_id and [row[f"n_{k}"] for k in PATTERNS] == [
                sum(s[1] == i for s in base) for i in range(4)
            ]
            kinds = list(PATTERNS)
            lines = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
            assert row.base_sha256 == hashlib.sha256(",".join(lines).encode()).hexdigest()
            assert set(lines) <= set(row.spans.split(",")) | {""} and row.spans.count(":") == 2 * (len(base) + row.n_added)
    assert pii.detect(docs.limit(0), None).collect() == []
    assert pii.train(docs.limit(0)) is None and pii.train(docs.where("doc_id > 1 and doc_id < 4")) is None


def test_samples_are_bounded_and_do_not_depend_on_partitions(spark):
    df = spark.range(10_000).select(F.col("id"), F.lit("x").alias("t"))
    one = {r.id for r in hashed_sample(df, 640, ["id"]).collect()}
    assert one == {r.id for r in hashed_sample(df.repartition(7), 640, ["id"]).collect()} and len(one) == 640
    assert len(hashed_sample(df.where("id < 100"), 640, ["id"]).collect()) == 100


def test_redact(spark):
    rows = [("to a@b.co: 1.2.3.4 and +1 (017) 555-7713.",), (None,), ("",), ("plain",), ("nr 4111111111111111",)]
    docs = spark.createDataFrame(rows, "text string").withColumn("doc_id", F.lit(None).cast("long"))
    got = [r.text for r in pii.redact(docs, None).collect()]
    assert got == ["to <EMAIL>: <IP> and <PHONE>.", None, "", "plain", "nr <CARD>"]


@pytest.mark.parametrize(
    "text, kind, whole, out",
    [
        ("to joerg.müller@firma.de now", 0, "joerg.müller@firma.de", "to <EMAIL> now"),
        ("call +1 (017) 555-7713 ext. 12 now", 3, "+1 (017) 555-7713 ext. 12", "call <PHONE> now"),
        ("to joerg.müller@firma.de now", 3, "joerg.müller@firma.de", "to joerg.mü<EMAIL> now"),  # not its kind
        ("to a@b.co, 1.2.3.4 now", 0, "a@b.co, 1.2", "to <EMAIL>, <IP> now"),  # cuts another one
    ],
)
def test_model_spans_extend_base_spans(spark, monkeypatch, text, kind, whole, out):
    at = text.index(whole)
    base = pii.base_spans(text)
    monkeypatch.setattr(pii, "model_spans", lambda texts, _: [[(at, kind, at + len(whole)), *base]] * len(texts))
    ((kept, added),) = pii.all_spans([text], object())
    assert kept == base and len(added) <= 1
    parts, end = [], 0
    for a, k, b in sorted(kept + added):
        if a >= end:
            parts += [text[end:a], f"<{pii.KINDS[k].upper()}>"]
        end = max(end, b)
    assert "".join([*parts, text[end:]]) == out
