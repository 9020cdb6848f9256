"""Whitening, fill-in-the-middle and neighbour voting against plain versions, with odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from switchback.llm import fill_middle, neighbours, whitening
from tests.llm.test_text_operators import docs_of


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts(r):
    signs = ["a", "é", "漢", "😀", " ", "\n", "\t", "\x0b", " ", "\x1c", "<", ">", "P", "word", "<P", "S>", "<M>"]
    return [None, "", " ", "\n\t ", "x", " x", "x ", "<P>", "<S", "P>", "<P"] + [
        "".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(300)
    ]


def test_fill_in_middle_equals_plain_version(spark):
    r = random.Random(1)
    rows = [(i, t) for i, t in enumerate(odd_texts(r))] + [(None, "no id here"), (5, "twice"), (5, "twice"), (7000, "long text é " * 200_000)]
    docs = docs_of(spark, rows).withColumns({"made": F.lit("mine"), "form": F.lit(1), "output": F.lit(2)})
    made = fill_middle.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "fim"]
    back = made.withColumn("back", fill_middle.restored(F.col("fim.output"), F.col("fim.form"))).collect()
    want = sorted(map(repr, (plain_fim(i, t) for i, t in rows)))
    assert sorted(repr(tuple(x["fim"][c] for c in ("n", "form", "prefix_chars", "middle_chars", "output"))) for x in back) == want
    assert all(x["back"] == (x["text"] or "") and x["made"] == "mine" for x in back)
    assert {x["fim"]["form"] for x in back} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_shifts_are_summed_over_windows(monkeypatch):
    monkeypatch.setattr(fill_middle, "BATCH_BYTES", 7)
    r = random.Random(2)
    texts = [t for t in odd_texts(r) if t is not None]
    forms = ["plain" if not t or re.search("<[PSM]>", t) else r.choice(["plain", "psm", "spm"]) for t in texts]
    raw = [t.encode() for t in texts]
    cut = fill_middle.cut_batch(raw, forms, [r.randrange(2**32) for _ in raw], [r.randrange(2**32) for _ in raw])
    assert fill_middle.restore_batch([c[3] for c in cut], forms) == raw
    assert fill_middle.cut_batch([], [], [], []) == [] and fill_middle.restore_batch([b"", b""], ["plain"] * 2) == [b"", b""]


def plain_whitening(vectors, components=4):
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    z = (x - total / n) @ parts[:, order] / np.sqrt(values[order])
    return n, ((n * x - total) ** 2).sum(axis=1), z, values[order] / values.sum()


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_whitening_equals_plain_version(spark, block_rows):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(120, 6)) * [5, 4, 3, 2, 1, 0.5] + 1).astype(np.float32).tolist()
    vectors += [vectors[0]] * 60 + [[0.0] * 6, [-0.0] * 6]
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [1.0] * 5 + [None], 1), (902, [float("nan")] * 6, 1), (903, [float("-inf")] + [0.0] * 5, 1), (904, [], 1), (905, [1.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, whitened int").repartition(5)
    n, deviation, z, shares = plain_whitening(vectors)
    out = whitening.whiten(df, block_rows=block_rows).collect()
    assert len(out) == 4 * len(vectors) and {x["n"] for x in out} == {n}
    got = np.zeros_like(z)
    for x in out:
        assert x["deviation"] == deviation[x["vec_id"]] and x["identity_error"] < 1e-9
        assert x["explained"] == pytest.approx(shares[x["component"] - 1])
        got[x["vec_id"], x["component"] - 1] = x["whitened"]
    sign = np.sign((got * z).sum(axis=0))
    assert np.allclose(got, z * sign, atol=1e-9)


def test_whitening_of_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # equal rows have no components
    two = whitening.whiten(make([(None, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()  # they differ in one direction
    assert sorted((str(x["vec_id"]), x["component"], x["n"], x["deviation"]) for x in two) == [("2", 1, 2, 2 * 256**2)] * 2 + [("None", 1, 2, 2 * 256**2)]
    assert {round(abs(x["whitened"]), 12) for x in two} == {1.0}
    huge = whitening.whiten(make([(1, [1e15, 0.0]), (2, [-1e15, 0.0]), (3, [0.0, 1.0])])).collect()
    assert all(x["deviation"] is None for x in huge if x["vec_id"] != 3)  # beyond 64 bits


def test_bags():
    known = neighbours._Words()
    assert neighbours.bag("", known)[:2] == ([], []) and len(neighbours.bag("", known)[2]) == 7
    assert neighbours.shape("AB12-c") == "A0-a" and neighbours.shape("ééé***") == "a***"
    rows = neighbours.rows_of(["a b", "", "x" * 1_000_000, "a\n" * 100_000], known)
    assert rows.shape == (4, neighbours.FEATURES) and np.isfinite(rows).all()


def plain_scores(model, rows):
    """All cosines at once, the nearest by sorting."""
    q = model._unit((rows * model.weights) @ model.space).astype(np.float64)
    near = q @ model.vectors.astype(np.float64).T
    out = []
    for s in near:
        best = np.argsort(-s)[: model.neighbours]
        w = np.maximum(s[best], 0) ** 2 * model.votes[best]
        out.append((w * model.labels[best]).sum() / w.sum() if w.sum() > 0 else model.prior)
    return np.array(out)


def test_votes_equal_plain_version(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 37)
    r = np.random.default_rng(4)
    known = neighbours._Words()
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choice(words[150 * (i % 2) :][:150], r.integers(5, 60))) for i in range(240)]
    model = neighbours.Model(neighbours.rows_of(texts[:200], known), np.arange(200) % 2, {0: 1000, 1: 100}, dimensions=20, neighbours=9)
    rows = neighbours.rows_of(texts[200:], known)
    scores = model.scores(rows)
    assert np.allclose(scores, plain_scores(model, rows), atol=1e-3)
    assert ((scores >= 0.3) == (np.arange(40) % 2 == 1)).mean() >= 0.9


def test_neighbours_learn_and_score(spark):
    r = random.Random(5)
    good = lambda: " ".join(f"g{r.randint(0, 80)}" for _ in range(40))
    junk = lambda: " ".join(f"g{r.randint(0, 80)}***" for _ in range(40))
    rows = [(i, good() if i % 3 else junk()) for i in range(300)]
    odd = [(1000, None), (1001, ""), (1002, "\n"), (None, good()), (4, good()), (1003, "漢" * 200_000)]
    docs = docs_of(spark, rows + odd)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(1, 0), (None, 1), (2, None), (5000, 1)], "doc_id long, quality int")
    model = neighbours.learn(docs, labels, sample=80)
    assert len(model.labels) <= 161
    out = neighbours.score(docs.withColumn("score", F.lit("old")), model).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= x["score"] <= 1 for x in out)
    scores = {x["doc_id"]: x["score"] for x in out if x["doc_id"] not in (None, 4)}
    assert all((scores[i] >= 0.3) == (i % 3 > 0) for i in range(300) if i != 4)
    assert neighbours.score(docs.limit(0), model).count() == 0
    none = neighbours.learn(docs, labels.limit(0))
    assert {x["score"] for x in neighbours.score(docs, none).collect()} == {0.5}
    one = neighbours.learn(docs, labels.filter("quality = 1"))
    assert {x["score"] for x in neighbours.score(docs, one).collect()} == {1.0}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = neighbours.learn(docs, labels)
    scored = neighbours.score(docs.join(labels.select("doc_id", "quality"), "doc_id"), model).filter(neighbours.held_out(F.col("doc_id")))
    got = {(r["quality"], r["p"]): r["n"] for r in scored.groupBy("quality", (F.col("score") >= 0.3).cast("int").alias("p")).agg(F.count("*").alias("n")).collect()}
    assert got.get((1, 0), 0) <= 0.005 * got[(1, 1)] and got.get((0, 1), 0) <= 0.15 * got[(0, 0)]
