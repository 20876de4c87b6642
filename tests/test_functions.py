"""Hand-derived cases of single functions, and greedy steps against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from figmine.functions import boxes as B
from figmine.functions import text as T
from figmine.operators import classify as K


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string" if not isinstance(value, list) else "x array<string>").select(f(F.col("x")).alias("y")).first()["y"]


CASES = [
    (T.clean_id, " arXiv:2401.13048 ", "2401.13048"), (T.clean_id, "arXiv:arxiv:2401.1", "2401.1"), (T.clean_id, "arxiv:arXiv:2401.13048", "arXiv:2401.13048"),
    (T.valid_id, "2401.13048", True), (T.valid_id, "quant-ph/9508027", True), (T.valid_id, "2401.130", False), (T.valid_id, "2401.13048v2", False), (T.valid_id, "math.AG/0601001", False),
    (T.figure_number, "Figure 3: x", 3), (T.figure_number, "Fig. 2(b)", 2), (T.figure_number, "FIG.4", None), (T.figure_number, "Figure IV. x", 4), (T.figure_number, "Fig. XII", None), (T.figure_number, "Figure illustrates", 1),
    (T.normalize_gate_ocr, "Rx(θ)", "RX"), (T.normalize_gate_ocr, "U1", "UI"), (T.normalize_gate_ocr, "T†", "TDG"), (T.normalize_gate_ocr, "√X", "SQRTX"), (T.normalize_gate_ocr, "Sdagger", "SDGGER"), (T.normalize_gate_ocr, "H 0", "HO"),
    (T.normalize_gates, ["cx", "CNOT", "Toffoli", "hadamard", "MEASURE", "Fredkin"], ["CNOT", "CCX", "H", "M", "CSWAP"]),
    (T.is_matrix_text, "1 0 0 1 0 1 1 0", True), (T.is_matrix_text, "Figure 3 shows the circuit", False), (T.is_matrix_text, "short", False), (T.is_matrix_text, None, False),
]


@pytest.mark.parametrize("f,value,want", CASES)
def test_case(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize("value,decision,words", [
    ("Quantum circuit for Grover", "ACCEPT", ["quantum circuit"]), ("Histogram of a quantum circuit output", "REJECT", ["histogram"]),
    ("Flowchart", "REJECT", ["flowchart"]), ("Quantum circuits", "PASS", []), ("", "PASS", [])])
def test_caption_filter(spark, value, decision, words):
    r = one(spark, value, T.caption_filter)
    assert (r["decision"], r["matched"]) == (decision, words)


@pytest.mark.parametrize("gates,want", [
    ([], (False, 0.0, "no_gates_found")), (["XX"], (False, 0.3, "no_quantum_specific_gates")), (["H"], (True, 0.6, "borderline_circuit")), (["H", "X"], (True, 0.6, "valid_quantum_circuit")),
    (["CNOT", "H", "X"], (True, 0.9, "valid_multi_qubit_circuit")), (["CNOT", "H", "RZ", "X"], (True, 1.0, "valid_multi_qubit_circuit"))])
def test_gate_validation(spark, gates, want):
    r = one(spark, gates, T.gate_validation)
    assert (r["ok"], r["confidence"], r["reason"]) == want


def test_prefix_and_position(spark):
    r = one(spark, "Figure 3: Circuit for QFT", lambda x: T.remove_figure_prefix(x, F.lit(100), F.lit(125)))
    assert (r["text"], r["start"], r["end"]) == ("Circuit for QFT", 110, 125)
    full = "One two\n three (four) five."
    place = lambda part: one(spark, full, lambda x: T.text_position(x, F.lit(part)))
    assert tuple(place("three (four)")) == (9, 21)
    assert tuple(place("ONE TWO three (four)")) == (0, 21)
    assert place("missing") is None


def test_suppress_and_merge():
    r = random.Random(3)
    for _ in range(30):
        b = np.array([[x := r.randint(0, 60), y := r.randint(0, 60), x + r.randint(1, 40), y + r.randint(1, 40)] for _ in range(r.randint(1, 12))], float)
        full = np.column_stack([b, b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]])
        kept = []
        for i in sorted(range(len(b)), key=lambda i: -(full[i, 4] * full[i, 5])):
            def share(j, i=i):
                w, h = min(b[i, 2], b[j, 2]) - max(b[i, 0], b[j, 0]), min(b[i, 3], b[j, 3]) - max(b[i, 1], b[j, 1])
                return w * h / (full[i, 4] * full[i, 5] + full[j, 4] * full[j, 5] - w * h) if w > 0 and h > 0 else 0
            if not any(share(j) > 0.4 for j in kept):
                kept.append(i)
        assert sorted(kept) == np.flatnonzero(B.suppress(full)).tolist()
        m = B.merge_near(b, 5)
        for i in range(len(m)):
            for j in range(i):
                gaps = [max(m[i, k], m[j, k]) - min(m[i, k + 2], m[j, k + 2]) for k in (0, 1)]
                assert max(gaps) > 5
    assert B.merge_near(np.array([[0, 0, 10, 10], [55, 0, 65, 10], [120, 0, 130, 10]]), 50).tolist() == [[0, 0, 65, 10], [120, 0, 130, 10]]
    nan = float("nan")
    assert B.suppress(np.array([[nan] * 4 + [100, 50], [nan] * 4 + [95, 45], [0, 0, 10, 10, 10, 10]])).tolist() == [True, False, True]


@pytest.mark.parametrize("w,h,readable,caption,gates,score,tier,ok", [
    (200, 200, False, "PASS", True, 0.9, "error", False), (50, 200, True, "ACCEPT", True, 0.9, "too_small", False), (200, 200, True, "ACCEPT", False, 0.1, "caption_whitelist_no_gates", False),
    (200, 200, True, "ACCEPT", True, 0.1, "caption_whitelist", True), (200, 200, True, "REJECT", True, 0.9, "caption_blacklist", False), (200, 200, True, "PASS", False, 0.7, "dinov2_high_no_gates", False),
    (200, 200, True, "PASS", True, 0.7, "dinov2_high", True), (200, 200, True, "PASS", True, 0.5, "dinov2_medium_rejected", False), (200, 200, True, "PASS", True, 0.49, "dinov2_low_rejected", False),
    (200, 200, True, "PASS", True, None, "detection_error", False)])
def test_decision(spark, w, h, readable, caption, gates, score, tier, ok):
    df = spark.createDataFrame([(w, h, readable, caption, gates, score)], "w int, h int, readable boolean, caption string, gates boolean, score double")
    r = df.select(K.decide(*(F.col(c) for c in df.columns)).alias("r")).first()["r"]
    assert (r["tier"], r["is_target"]) == (tier, ok)


def test_paper_list(spark, tmp_path):
    from figmine.sources.paper_list import read_paper_list

    (tmp_path / "ids.txt").write_text("# list\n2401.13048\n\narXiv:2401.13048\nbad\nquant-ph/9508027\n")
    rows = read_paper_list(spark, str(tmp_path / "ids.txt")).orderBy("line_no").collect()
    assert [r["kind"] for r in rows][:6] == ["comment", "valid", "empty", "duplicate", "invalid", "valid"]
    assert read_paper_list(spark, str(tmp_path / "none.txt")).count() == 0
