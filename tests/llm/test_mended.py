"""Many languages, columns with internal names, colour masks, the landing of the mix, two pipelines at once."""

import random
import struct
import threading
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from figmine.llm import langid, media, mixing
from tests.llm.test_hard_cases import odd_documents
from tests.llm.test_llm import SCHEMA

#: names that operators make beside the columns of a table
INTERNAL = [
    "__drops", "__drop_id", "__drop_print", "drops", "print", "__kept", "__row", "__key", "__at", "__mix", "__size", "__text", "__toxicity", "row", "key", "mix", "rank", "bucket", "target", "whole", "p",
    "at", "h1", "h2", "score", "component_id", "n_shingles", "class", "node", "root", "chunk", "payload", "toxic", "predicted", "item", "n_hit",
]


def test_seventy_languages(spark):
    r = random.Random(3)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:02d}": ["".join(r.sample(alphabet, r.randint(3, 7))) for _ in range(12)] for k in range(70)}
    data = [(i, " ".join(r.choices(words[f"l{i % 70:02d}"], k=40)), f"l{i % 70:02d}", "s", 0) for i in range(70 * 14)]
    out = langid.language_id(spark.createDataFrame(data, SCHEMA)).collect()
    lang = {i: x for i, _, x, *_ in data}
    held = [x for x in out if x["held_out"]]
    assert {x["lang_pred"] for x in out} == set(words)
    assert sum(x["lang_pred"] == lang[x["doc_id"]] for x in held) >= 0.98 * len(held)


def test_tables_of_languages_are_one_model():
    import pyarrow as pa

    names, texts = ["a", "b", "c"], [pa.array(["abab abba"]), pa.array(["bcbc"]), pa.array(["caca cab"])]
    asked = pa.array(["abc", "", "cabbage", None])
    whole = langid.Languages(names, texts).bits(asked)
    assert np.allclose(langid.Languages(names, texts, together=1).bits(asked), whole) and whole.shape == (4, 3)


def test_internal_names_in_all_stages(spark, sf):
    plain = odd_documents(spark)
    wide = plain.selectExpr("*", *(f"cast(place as string) as `{c}`" for c in INTERNAL if c not in plain.columns))
    for name, stage in corpus_pipeline.STAGES:
        want, got = stage(spark, plain, sf), stage(spark, wide, sf)
        if name != "mix_sources":
            assert got.columns == wide.columns, name
        rows = [r.asDict() for r in got.collect()]
        assert sorted((r["place"], r["text"]) for r in rows) == sorted((r["place"], r["text"]) for r in want.collect()), name
        for r in rows:
            assert all(r[c] == str(r["place"]) for c in INTERNAL if c not in plain.columns and c.lower() not in mixing.OUTPUTS), name


def bmp(masks, pixels, compression=3):
    body = b"".join(struct.pack("<I", x) for x in pixels)
    return b"BM" + struct.pack("<IHHI", 66 + len(body), 0, 0, 66) + struct.pack("<IiiHHIIiiII", 40, len(pixels), 1, 1, 32, compression, 0, 0, 0, 0, 0) + struct.pack("<III", *masks) + body


def test_colour_masks():
    assert media.decode(bmp((0xFF, 0xFF00, 0xFF0000), [0x0000FF, 0xFF0000])).tolist() == [[[255, 0, 0], [0, 0, 255]]]
    assert media.decode(bmp((0xFF0000, 0xFF00, 0xFF), [0xFF0000])).tolist() == [[[255, 0, 0]]]
    assert media.decode(bmp((0xFF000000, 0xFF0000, 0xFF00), [0x0A0B0C0D])).tolist() == [[[10, 11, 12]]]
    for masks in ((0x3FF, 0xFFC00, 0x3FF00000), (0xFF, 0xFF, 0xFF00), (0, 0, 0)):
        with pytest.raises(ValueError, match="masks"):
            media.decode(bmp(masks, [1]))


def test_landing_is_near(spark):
    """Sources of some fifty documents, sizes from 1 to 400: within one per cent."""
    r = random.Random(8)
    data = [(i, "w " * r.choice([1, 3, 20, 60, r.randint(1, 400)]), "en", f"s{i % 30:02d}", 0) for i in range(1500)]
    taken, target = defaultdict(int), {}
    for x in mixing.mix(spark.createDataFrame(data, SCHEMA)).collect():
        taken[x["doc_id"] % 30] += x["taken"]
        target[x["doc_id"] % 30] = x["target"]
        assert x["taken"] <= 2 * x["size"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)


def test_landing_keeps_probabilities():
    """Documents outside the landing are drawn by the flight alone: each about as often as its probability says."""
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 500, 60), rng.uniform(0.1, 0.9, 60)
    drawn = np.mean([mixing.last_flight(p, size, np.random.default_rng(k)) for k in range(3000)], axis=0)
    assert np.sort(np.abs(drawn - p))[: 60 - mixing.LANDING - 2].max() < 0.06 and set(np.unique(mixing.last_flight(p, size, rng))) <= {0.0, 1.0}


def test_two_pipelines_at_once(spark, sf):
    made, faults = [], []

    def run():
        try:
            made.append(sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=repr))
        except Exception as e:  # noqa: BLE001
            faults.append(e)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not faults and made[0] == made[1] and made[0]
