import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_simhash_index import brute as brute_classes
from tests.llm.test_suffix_radix import covered
from tideline.llm import personal_data, rule_quality, suffix_radix, token_packing
from tideline.llm.tables import load

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_run(spark, sf_dir):
    """Pieces by (doc_id, piece) from a plain version of all stages in one process."""
    docs = load(spark, sf_dir, "documents")
    model = rule_quality.train(docs, load(spark, sf_dir, "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if model.score(np.array([rule_quality.statistics(t)]))[0] >= 0.3}
    rows = {i: rows[i] for i, _, first in brute_classes(list(rows.items())) if i == first}
    spans = covered([(t or "").encode() for t in rows.values()], 200)
    for (i, t), (s, e) in zip(list(rows.items()), spans):
        body = (t or "").encode()
        gone = np.array([y - x >= 400 or len(body[x:y].split()) >= 50 for x, y in zip(s, e)], bool)
        rows[i] = suffix_radix.cut_text(body, s[gone], e[gone])
    cleaned = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    tagger = personal_data.train(cleaned)
    out = {}
    for (i, text), (base, added) in zip(rows.items(), personal_data.all_spans(list(rows.values()), tagger)):
        parts, at = [], 0
        for a, kind, b in sorted(base + added):
            if a >= at:
                parts += [text[at:a], f"<{personal_data.KINDS[kind].upper()}>"]
            at = max(at, b)
        data = token_packing._word_ids(token_packing.TOKENIZER)("".join([*parts, text[at:]])) + b"\0\0\0\0"
        for k in range(0, len(data), 4 * 2048):
            part = data[k : k + 4 * 2048]
            out[i, k // 8192] = (len(part) // 4, zlib.crc32(part))
    return out


def test_run_equals_a_plain_version(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in got} == plain_run(spark, SMALL)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for place in places.values():
        ends = [0]
        for offset, length in sorted(place):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 1


@pytest.fixture()
def odd(spark):
    text = "the cat sat on the mat and " * 30
    rows = [(1, text, "en", "a", 1), (2, text, "en", "a", 2), (2, text, None, "b", 3), (2, text, None, "b", 3), (3, None, None, None, None),
            (4, "", "en", "s", 0), (None, "mail a@b.co now", "en", "s", 5), (6, "x " * 60_000, "de", "s", 9), (7, "call +1 (017) 555-7713", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return docs.withColumns({"score": F.lit("x"), "rest": F.lit(1), "key": F.lit(2), "_row": F.lit(3), "kept": F.create_map(F.lit(1), F.lit(2))})


def test_stages_keep_columns_and_survive_odd_rows(spark, odd):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeats", "private", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, SMALL)
            assert out.dtypes == docs.dtypes
            out.collect()
    assert corpus_pipeline.packing(spark, odd.limit(0), SMALL).collect() == []
    near = corpus_pipeline.near_copies(spark, odd, SMALL).collect()
    assert sorted(str(r.doc_id) for r in near) == ["1", "3", "6", "7", "None"]
    private = {r.doc_id: r for r in corpus_pipeline.private(spark, odd, SMALL).collect()}
    assert private[None].text == "mail <EMAIL> now" and private[None].n_chars == 16
    assert private[7].text == "call <PHONE>" and private[3].text is None
    repeats = corpus_pipeline.repeats(spark, odd, SMALL).collect()
    assert {r.doc_id: r.text for r in repeats}[1] == "" and {r.doc_id: r.n_chars for r in repeats}[7] == 22


def test_quality_stage_keeps_clean_documents(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs = load(spark, folder, "documents").select(*COLUMNS)
    kept = corpus_pipeline.quality(spark, docs, folder)
    labels = load(spark, folder, "labels")
    joined = kept.join(labels, "doc_id").groupBy("quality").count().collect()
    by = {r.quality: r["count"] for r in joined}
    held = {r.quality: r["count"] for r in labels.join(docs, "doc_id").groupBy("quality").count().collect()}
    assert by[1] >= 0.995 * held[1] and by.get(0, 0) <= 0.05 * held[0]


def test_rows_of_one_id_are_kept_by_group(spark):
    a, b, c = ("the cat sat on the mat " * 9, "rain fell over seven quiet hills " * 9, "old maps show no roads at all " * 9)
    for x, y, z in [(a, b, c), (b, c, a), (c, a, b)]:
        rows = [(1, x, "en", "s", 1), (2, x, "en", "s", 1), (2, y, "en", "s", 1), (3, y, "en", "s", 1), (4, z, "en", "s", 1), (4, z, "en", "s", 1)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
        got = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect())
        assert got == [(1, x), (2, y), (4, z)]
