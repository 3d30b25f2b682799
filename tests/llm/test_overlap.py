from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from wavequarry.llm import overlap

SCHEMA = "path string, x array<array<float>>, fp string, split string"


def signal(rng, channels=12, n=64):
    noise = rng.normal(size=(channels, n + 2))
    return np.array([np.convolve(c, [0.25, 0.6, 0.25], "valid") for c in noise])


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    rows, splits, want = [], [], set()
    for k in range(60):
        x = signal(rng)
        rows.append((f"t{k}", x))
        splits.append(("train", f"t{k}"))
        copy = x.copy()
        if k == 0:
            pass
        elif k == 1:
            copy += rng.normal(size=copy.shape) * 0.01
        elif k == 2:
            copy *= 1.3
        elif k == 3:
            copy = copy[rng.permutation(12)]
        elif k == 4:
            copy[:2] = signal(rng)[:2]
        elif k == 5:
            copy[:, 20:26] = 0
        elif k == 6:  # the next window of the recording
            copy = np.hstack([x[:, 32:], signal(rng)[:, :32]])
        else:
            copy = signal(rng)
        rows.append((f"v{k}", copy))
        splits.append(("val" if k % 2 else "test", f"v{k}"))
        if k < 6:
            want.add((f"t{k}", f"v{k}"))
    splits += [("val", "t50"), ("train", "t50"), ("test", "missing"), ("val", None)]
    want.add(("t50", "t50"))
    rows.append(("t51", None))
    rows.append(("v51", rows[1][1]))
    data = [(p, None if x is None else x.tolist(), "clash", "clash") for p, x in [*rows, rows[0], (None, rows[0][1]), ("unlisted", rows[0][1])]]
    flat = [("f1", [[1.0] * 64]), ("f2", [[1.0] * 64]), ("f3", [[2.0] * 64]), ("e1", []), ("s1", [[1.0, 2.0], []])]
    data += [(p, x, "", "") for p, x in flat]
    splits += [("train", "f1"), ("val", "f2"), ("val", "f3"), ("train", "e1"), ("val", "s1")]
    want.add(("f1", "f2"))
    return spark.createDataFrame(data, SCHEMA), spark.createDataFrame(splits, "split string, path string"), want


def test_finds_the_planted_pairs(tables):
    signals, splits, want = tables
    found = [(r["train_path"], r["eval_path"]) for r in overlap.cross_split_pairs(signals, splits).collect()]
    assert len(found) == len(set(found))
    assert set(found) - {("t0", "v51")} == want  # v51 was stored a second time with another signal; one of them counts


def test_empty(spark, tables):
    signals, splits, _ = tables
    assert overlap.cross_split_pairs(signals.limit(0), splits).count() == 0
    assert overlap.cross_split_pairs(signals, splits.limit(0)).count() == 0


def cosine_pairs(classes, threshold):
    n = len(classes)
    df = Counter(t for *_, terms in classes for t in set(terms))
    vectors = []
    for fp, a, b, terms in classes:
        w = {t: math.log1p(n / df[t]) for t in set(terms)}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        vectors.append((fp, a, b, {t: v / norm for t, v in w.items()}))
    out = {}
    for e, _, is_eval, v in vectors:
        for t, is_train, _, u in vectors:
            if is_eval and is_train and e != t:
                dot = sum(v[k] * u[k] for k in v.keys() & u.keys())
                if dot >= threshold:
                    out[e, t] = dot
    return out


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.7])
def test_cosine_join_is_exact(spark, threshold):
    rng = np.random.default_rng(int(threshold * 10))
    hot = [1, 2, 3]
    classes = [(k, bool(rng.random() < 0.6), bool(rng.random() < 0.6), [int(t) for t in rng.zipf(1.3, 12) % 500] + hot * (k % 3 > 0)) for k in range(150)]
    table = spark.createDataFrame(classes, "fp bigint, in_train boolean, in_eval boolean, terms array<bigint>")
    got = {(r["eval_fp"], r["train_fp"]): r["cosine"] for r in overlap.cosine_join(table, threshold).collect()}
    want = cosine_pairs(classes, threshold)
    sure = {k for k, v in want.items() if abs(v - threshold) > 1e-9}
    assert sure <= got.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_report(tables):
    signals, splits, want = tables
    report = overlap.overlap_report(overlap.cross_split_pairs(signals, splits), splits, lambda p: p.substr(1, 1)).collect()
    assert sum(r["pairs"] for r in report) >= len(want)


def test_a_hot_group_of_equal_and_altered_signals(spark):
    rng = np.random.default_rng(8)
    hot = signal(rng)
    rows = [(f"h{k}", hot) for k in range(30)] + [(f"n{k}", hot + rng.normal(size=hot.shape) * 0.005) for k in range(10)] + [(f"o{k}", signal(rng)) for k in range(60)]
    split = {p: "train" if k % 2 else "val" for k, (p, _) in enumerate(rows)}
    table = spark.createDataFrame([(p, x.tolist(), "", "") for p, x in rows], SCHEMA)
    found = {(r["train_path"], r["eval_path"]) for r in overlap.cross_split_pairs(table, spark.createDataFrame([(s, p) for p, s in split.items()], "split string, path string")).collect()}
    group = [p for p, _ in rows[:40]]
    assert found == {(a, b) for a in group for b in group if split[a] == "train" and split[b] == "val"}


def test_shifted_copies_are_found_and_the_next_window_is_not(spark):
    rng = np.random.default_rng(11)
    rows, splits, want = [], [], set()
    for k in range(40):
        long = signal(rng, n=110)
        shift = (-3, -2, -1, 1, 2, 3)[k % 6] if k < 24 else 32
        rows += [(f"t{k}", long[:, 10:74]), (f"v{k}", long[:, 10 + shift : 74 + shift])]
        splits += [("train", f"t{k}"), ("test", f"v{k}")]
        if k < 24:
            want.add((f"t{k}", f"v{k}"))
    table = spark.createDataFrame([(p, x.tolist(), "", "") for p, x in rows], SCHEMA)
    pairs = overlap.cross_split_pairs(table, spark.createDataFrame(splits, "split string, path string")).collect()
    assert {(r["train_path"], r["eval_path"]) for r in pairs} == want


def test_long_posting_lists_are_joined_in_slices(spark, monkeypatch):
    monkeypatch.setattr(overlap, "SLICE", 7)
    test_cosine_join_is_exact(spark, 0.3)


def test_the_choice_among_rows_of_a_path_does_not_depend_on_their_order(spark):
    rng = np.random.default_rng(12)
    x, y = signal(rng), signal(rng)
    rows = [("a", x), ("a", y), ("b", x), ("c", y)]
    splits = spark.createDataFrame([("train", "a"), ("val", "b"), ("test", "c")], "split string, path string")
    found = [
        {(r["train_path"], r["eval_path"]) for r in overlap.cross_split_pairs(spark.createDataFrame([(p, v.tolist(), "", "") for p, v in order], SCHEMA), splits).collect()}
        for order in (rows, rows[::-1])
    ]
    assert found[0] == found[1] and len(found[0]) == 1
