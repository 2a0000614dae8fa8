"""Secrets: base spans against Python's regular expressions, the chains against plain counting and on held-out tokens."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import secret_models as sm
from tideline.llm.tables import load

PATTERNS = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
)


def base(text):
    found = [
        (m.start(), i, m.end())
        for i, (pattern, group, least) in enumerate(PATTERNS)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return sorted(found)


def ordinary(n, seed=1):
    """Identifiers and words with numbers that the models were not fitted on."""
    rng = random.Random(seed)
    parts = "get set user value count index parse stream window table column buffer request handler config total".split()
    out = set()
    while len(out) < n:
        chosen = [rng.choice(parts) for _ in range(rng.randrange(3, 6))]
        style = rng.randrange(4)
        name = ["_".join(chosen), chosen[0] + "".join(p.title() for p in chosen[1:]), "-".join(chosen), "_".join(chosen).upper()][style]
        out.add(f"{name}{rng.randrange(2024)}")
    return sorted(out)


def randoms(n, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        raw = rng.randbytes(24)
        out.append([raw.hex(), base64.b64encode(raw).decode(), base64.urlsafe_b64encode(raw).decode(), raw.hex().upper()][i % 4])
    return [x for x in out if re.search("[0-9]", x) and re.search("[A-Za-z]", x)]


def texts():
    key = "AKIA" + "Q7" * 9
    return [
        None, "", " ", "password=hunter22", "PassWord : 'abc'", 'api_key: "x.y/z=+-_" then apikey=abcdefgh.',
        "secret=token: abcdefgh", "secret=tokens: abcdefgh", "token==abcdef", "token =  \"ab", "password\n=abcdefg",
        f"{key} AKIAAKIA{'Z' * 9} AKIA{'Z' * 15} x{key}", "deadbeef" * 3, "deadbeef" * 2 + "dead BEEF" + "a" * 24 + "g" + "f" * 23,
        f"é🙂 token='{'0f' * 20}' 🙂 {'0f' * 12}", "token=" * 5 + "abcdef", "passwd:a secret=b api_key=c", "KKapiKey=abcdefgh",
        "password=abcdefg " * 200, "x" * 200_000 + " " + "ab12" * 6, ("no secret here, " * 20_000) + "secret=1234567",
        "passwd\x00=abcdefgh", "퟿ token=\tabcdefgh", "token=abcdef\r\ntoken=ghijkl",
    ]


def digest(spans):
    kinds = (*sm.KINDS, sm.ADDED)
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def check_base(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in sm.detect(df, None).collect()}
    for i, text in enumerate(rows):
        expected, r = base(text), got[i]
        assert r.spans == digest(expected), repr(text)[:200]
        assert r.base_sha256 == hashlib.sha256(digest(expected).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in expected) for j in range(3))


def test_base_spans_as_python_finds_them(spark):
    check_base(spark, texts())


PARTS = ["token", "SECRET", "api_", "key", "=", ":", " ", '"', "'", "a", "0f0f0f0f", "AKIA", "Z9Z9Z9Z9", "é", "🙂", "\n", "g"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=40, max_size=40))
def test_base_spans_of_generated_texts(spark, rows):
    check_base(spark, rows)


@pytest.fixture(scope="module")
def models(spark):
    return sm.train(load(spark, SMALL.replace("0.001", "0.01"), "documents"))


def test_chains_are_counted_ratios(spark):
    rows = [("abab", True), ("ab9!", True), ("aabb", False), ("ba", False), (None, True), ("x", None), ("", False)]
    got = sm.fit(spark.createDataFrame(rows, "value string, random boolean")).ratios
    number = {c: i for i, c in enumerate(sm.SYMBOLS)}
    pairs = {label: Counter() for label in (True, False)}
    for value, label in rows:
        if value and label is not None:
            codes = [number.get(c, sm.ALPHABET - 1) for c in value]
            pairs[label].update(zip(codes, codes[1:]))
    for a, b in [(0, 1), (1, 0), (0, 0), (1, 61), (61, 66), (5, 5), (66, 0)]:
        p = [(pairs[x][a, b] + 0.5) / (sum(n for (c, _), n in pairs[x].items() if c == a) + 0.5 * sm.ALPHABET) for x in (True, False)]
        assert got[a * sm.ALPHABET + b] == pytest.approx(math.log(p[0] / p[1]), abs=1e-6)


def judged(spark, models, tokens):
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    return [r[0] for r in df.select(sm.is_random(F.col("t"), models)).collect()]


def test_held_out_tokens(spark, models):
    found, false = judged(spark, models, randoms(800)), judged(spark, models, ordinary(800))
    assert sum(found) / len(found) >= 0.95 and sum(false) / len(false) <= 0.01


def test_ratio_is_a_plain_sum(spark, models):
    tokens = randoms(50) + ordinary(50) + ["a", "", "é🙂é"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    number = {c: i for i, c in enumerate(sm.SYMBOLS)}
    for token, ratio in df.select("t", sm.ratio(F.col("t"), models)).collect():
        codes = [number.get(c, sm.ALPHABET - 1) for c in token]
        plain = sum(models.ratios[a * sm.ALPHABET + b] for a, b in zip(codes, codes[1:]))
        assert ratio == pytest.approx(plain, abs=1e-9), token


def test_model_adds_spans_beside_base_ones(spark, models):
    new = base64.b64encode(bytes(range(200, 230))).decode().replace("+", "x")
    rows = [f"see {new}, and deadbeefdeadbeefdeadbeef", f"token={new}", "the get_user_value_index_2024 word", "4929348385146306 digits", None]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(rows)], "doc_id long, text string, base string, _tokens int")
    got = {r.doc_id: r for r in sm.detect(df, models).collect()}
    assert got[0].spans == f"random:4:{4 + len(new)},hex:{10 + len(new)}:{34 + len(new)}"
    assert (got[0].n_added, got[0].n_hex) == (1, 1)
    assert got[1].spans == f"assign:0:{6 + len(new)}" and [got[i].n_added for i in (1, 2, 3, 4)] == [0] * 4
    without = {r.doc_id: r for r in sm.detect(df, None).collect()}
    assert all(without[i].base_sha256 == got[i].base_sha256 for i in got)


def test_clean_documents_are_left_alone(spark, models):
    docs = load(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = sm.detect(docs, models).collect()
    assert len(rows) == docs.count() and sum(r.n_added for r in rows) <= 3


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sm.train(empty) is None and sm.detect(empty, None).count() == 0
    plain = spark.createDataFrame([(1, "no secret at all")], "doc_id long, text string")
    assert sm.train(plain) is None


def test_main_path_is_native(spark, models):
    plan = sm.detect(load(spark, SMALL, "documents"), models)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
