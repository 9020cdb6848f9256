"""Near-dedup, mixing, resharding, secret scans, toxicity and the pipeline against plain versions, with odd inputs."""

import itertools
import os
import random
import re
import subprocess
import sys
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from switchback.llm import automata, bpe, components, line_dedup, mixing, near_dedup, queries, repetition, resharding, secret_scan, toxicity
from tests.llm.test_text_operators import docs_of, plain_line_dedup


def plain_components(rows, percent=75):
    sets, parent = {}, {}
    for i, t in rows:
        words = (t or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", words)
        own = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        sets.setdefault(i, []).append(own)
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in sets}


def near_copies(r, n):
    rows, next_id = [], 0
    for _ in range(n):
        words = [f"w{r.randint(0, 400)}" for _ in range(r.choice([1, 3, 6, 40, 120]))]
        for _ in range(r.randint(1, 6)):
            own = list(words)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                own[r.randrange(len(own))] = f"x{r.randint(0, 9)}"
            rows.append((next_id, " ".join(own).title() if r.random() < 0.3 else "\t".join(own)))
            next_id += r.randint(1, 3)
    return rows


def test_near_dedup_equals_all_pairs(spark):
    rows = near_copies(random.Random(1), 40) + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "one"), (905, "ONE"), (906, "É"), (907, "é")]
    got = {x["doc"]: (x["n_shingles"], x["component"]) for x in near_dedup.near_components(docs_of(spark, rows)).collect()}
    assert {k: v[1] for k, v in got.items()} == plain_components(rows)
    assert got[900][0] == 0 and got[903][0] == 1 and got[905][1] == 903


def test_near_dedup_of_repeated_and_missing_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, a), (2, a), (2, b), (3, b), (None, a), (7, "short"), (7, "short")]
    found = {(x["doc"], x["component"]) for x in near_dedup.near_components(docs_of(spark, rows)).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (2**63 - 1, 1), (7, 7)}
    kept = near_dedup.keep_first(docs_of(spark, rows))
    assert sorted(x["doc_id"] for x in kept.collect()) == [1, 7, 7] and "hash" in kept.columns
    assert near_dedup.near_components(docs_of(spark, [])).count() == 0


def test_a_bucket_without_links_to_its_anchor(spark):
    # one long passage in common, then two families of near copies: every bucket of the passage is mixed
    r, common = random.Random(2), [f"c{i}" for i in range(60)]
    rows = []
    for i in range(24):
        own = [f"f{i % 4}_{k}" for k in range(40)]
        own[r.randrange(40)] = f"e{i}"
        rows.append((i, " ".join(common + own)))
    got = {x["doc"]: x["component"] for x in near_dedup.near_components(docs_of(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(205, 205), (300, 299)]
    out = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[k] == 100 for k in range(100, 130)) and out[300] == 299
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] for s in full} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s] or sizes[s] == 0}
        if not above:
            return target
        full |= above


def test_mix_targets_and_copies(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", "b", "b", "b", "c", "é", None]), "w " * r.randint(0, 40)) for i in range(400)] + [(1, "b", "w w"), (None, "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.with_copies(docs).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    taken = defaultdict(int)
    for x in out:
        assert x["__target"] == pytest.approx(want[x["source"]]) and x["__source_size"] == sizes[x["source"]] and 0 <= x["__copies"] <= 3
        taken[x["source"]] += x["__size"] * x["__copies"]
    assert len(out) == len(rows) and taken["z"] == 0
    assert all(abs(taken[s] - want[s]) <= 0.35 * want[s] + 40 for s in want)
    again = mixing.mix(docs)
    assert again.columns == docs.columns and again.count() == sum(x["__copies"] for x in out)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_flow_is_cheapest():
    r = random.Random(4)
    for _ in range(150):
        n, m = r.randint(1, 3), r.randint(1, 3)
        supply, room = [r.randint(0, 2) for _ in range(n)], [r.randint(0, 3) for _ in range(m)]
        cost = [[r.randint(0, 4) for _ in range(m)] for _ in range(n)]
        if sum(supply) > sum(room):
            with pytest.raises(ValueError):
                resharding.minimum_cost_flow(supply, room, cost)
            continue
        flow = resharding.minimum_cost_flow(supply, room, cost)
        assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= room[j] for j in range(m))
        units, places = [i for i, k in enumerate(supply) for _ in range(k)], [j for j, k in enumerate(room) for _ in range(k)]
        best = min(sum(cost[u][p] for u, p in zip(units, way)) for way in itertools.permutations(places, len(units)))
        assert sum(f[j] * cost[i][j] for i, f in enumerate(flow) for j in range(m)) == best


def rows_to_place(spark, texts, shards=3):
    rows = [(i, zlib.crc32(t.encode()) % shards, len(t.encode()) + 1, t, 5) for i, t in texts]
    df = spark.createDataFrame(rows, "id long, old int, size long, text string, slot int")
    return df.withColumn("hash", F.xxhash64("text"))


def test_resharding_evens_sizes_and_keeps_groups(spark):
    r = random.Random(5)
    texts = [(i, "t" * r.randint(0, 50) + str(r.randint(0, 300))) for i in range(3000)] + [(k, "hot") for k in range(5000, 9000)] + [(None, "no id"), (1, "again")]
    out = resharding.reshard(rows_to_place(spark, texts), 4).collect()
    assert len(out) == len(texts)
    sizes, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for x in out:
        sizes[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
        groups[x["text"]].add(x["shard"])
    mean = sum(sizes.values()) / 4
    assert set(sizes) == {0, 1, 2, 3} and all(abs(v - mean) < 0.03 * mean for v in sizes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for t, v in groups.items() if t != "hot")
    least = sum(max(0, sum(x["size"] for x in out if x["old"] == o) - mean) for o in range(3))
    moved = sum(x["size"] for x in out if x["old"] != x["shard"])
    assert moved <= least + 0.05 * mean
    assert resharding.reshard(rows_to_place(spark, [(1, "x")]).limit(0), 4).count() == 0


def test_only_crossed_blocks_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resharding, "BLOCK_BITS", 4)
    texts = [(i, f"text {i} " * (1 + i % 7)) for i in range(2000)]
    rows = rows_to_place(spark, texts)
    placed = resharding.reshard(rows, 4)
    old = str(tmp_path / "old")
    block = F.shiftrightunsigned("hash", 64 - resharding.BLOCK_BITS).cast("int")
    rows.withColumn("block", block).drop("slot").write.partitionBy("old", "block").parquet(old)
    manifest = resharding.rewrite(placed, old, str(tmp_path / "new"), F.col("id"), F.col("hash")).collect()
    actions = {x["action"]: x["n"] for x in resharding.block_actions(placed).groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert actions["kept"] > 20 and actions["moved"] >= 3 and 1 <= actions["rewritten"] <= 8
    want = {x["id"]: x["shard"] for x in placed.collect()}
    got = {}
    for m in manifest:
        for x in spark.read.parquet(m["path"]).select("id").collect() if m["path"].startswith(str(tmp_path / "new")) else []:
            got[x["id"]] = m["shard"]
    assert got and all(want[i] == s for i, s in got.items())


SECRETS = "token: abcdefghijkl password = 'short' API_KEY=\"Zz9/+_.=-AAAAAAAA\" AKIA0123456789ABCD AKIASHORT deadbeefdeadbeef deadbeef secret=passwd=abcdefghijklmno"


def test_base_spans():
    found = [(k, SECRETS[s:e]) for k, s, e in secret_scan.Scanner(None).spans(SECRETS)]
    assert found == [
        ("assign", "token: abcdefghijkl"), ("assign", 'API_KEY="Zz9/+_.=-AAAAAAAA'), ("access", "AKIA0123456789ABCD"), ("hex", "deadbeefdeadbeef"),
        ("assign", "secret=passwd=abcdefghijklmno"),
    ]
    assert secret_scan.base_spans("\u017fecret=abcdefghijklmnop") == []
    assert secret_scan.base_spans("toKen=abcdefghijklmnop") == []


def test_automata_tell_formats_apart():
    r = random.Random(6)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(32)) for _ in range(300)]
    keys = ["AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(300)]
    model = automata.Automaton(keys)
    assert len(model.steps) < 60  # merged far below the 300 * 16 states of the tree
    assert model.log_likelihood("AKIA" + "QWERTYUIOPASDFGH") > model.log_likelihood("BKIA" + "QWERTYUIOPASDFGH") + 5
    words = ["-".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(3)) for _ in range(300)]
    words += ["".join(r.choice(["some", "thing", "any", "else", "other", "where"]) for _ in range(4)) for _ in range(300)]  # what is alien to all ordinary runs is found
    formats = secret_scan.Formats({"hex": hexes, "access": keys}, words)
    fresh = ["".join(r.choice("0123456789abcdef") for _ in range(32)) for _ in range(50)]
    assert sum(map(formats.is_secret, fresh)) >= 45 and not any(map(formats.is_secret, ["beta-gamma-alpha", "delta-delta-beta", "somethingelse"]))


PLAIN = "plain words here longer terms often joined by hyphens".split()


def test_scan_of_odd_texts(spark):
    r = random.Random(7)
    rows = [(i, f"é key=x token={''.join(r.choice('0123456789abcdef') for _ in range(24))} {'-'.join(r.choice(PLAIN) for _ in range(3))} and more") for i in range(60)]
    rows += [(100, None), (101, ""), (102, SECRETS), (102, SECRETS), (None, "x" * 100_000 + " deadbeefdeadbeef"), (103, "see 0f1e2d3c4b5a69 there")]
    docs = docs_of(spark, rows)
    out = secret_scan.scan(docs, secret_scan.learn(docs, false_positives=0.05))  # so few ordinary runs tell little
    for x in out.collect():
        text = x["text"] or ""
        base = [tuple(s) for s in x["spans"] if s["kind"] != "format"]
        assert base == sorted(secret_scan.base_spans(text), key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
        if x["doc_id"] == 103:
            assert [text[s["start"] : s["end"]] for s in x["spans"]] == ["0f1e2d3c4b5a69"]
    hidden = out.filter("doc_id = 102").select(secret_scan.redact(F.col("text"), F.col("spans"))).first()[0]
    assert "deadbeefdeadbeef" not in hidden and hidden.endswith("[secret]") and "password = 'short'" in hidden
    assert secret_scan.scan(docs.limit(0), None).count() == 0


def test_background_counts_every_ordinary_run(spark):
    r = random.Random(11)
    runs = ["-".join(r.choice(PLAIN) for _ in range(4)) for _ in range(400)] + ["Q" * 300 + "Zq"]
    docs = docs_of(spark, [(i, f"{s} and {s} token=abcdef0123456789") for i, s in enumerate(runs)])
    want = defaultdict(int)
    for s in set(runs):
        for p in zip("^" + s, s):
            want[p] += 1
    assert {(x["a"], x["b"]): x["n"] for x in secret_scan.ordinary_pairs(secret_scan.ordinary_runs(docs)).collect()} == want
    few, many = secret_scan.learn(docs, 20).background, secret_scan.learn(docs, 1500).background
    assert few.pairs == many.pairs and few.pairs.keys() == want.keys() and ("Z", "q") in few.pairs


def plain_pieces(text):
    """Runs of token signs of 12 and more that no base match touches, sign by sign."""
    free = [c for c in text]
    for _, s, e in secret_scan.base_spans(text):
        free[s:e] = [" "] * (e - s)
    out, run = [], None
    for i, c in enumerate([*free, " "]):
        token = c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
        if token and run is None:
            run = i
        elif not token and run is not None:
            if i - run >= 12:
                out.append((run, i))
            run = None
    return out


def test_pieces_are_what_base_spans_leave():
    r = random.Random(12)
    parts = ["deadbeefdeadbeef", "token=abcdefghijkl", "AKIA0123456789ABCD", "plainword", "longerplainword", "XyZ12", " ", "/", "-"]
    for _ in range(400):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 9)))
        assert secret_scan.pieces(text, secret_scan.base_spans(text)) == plain_pieces(text), text


def test_tokens_of_other_formats_are_found(spark):
    r = random.Random(13)
    sign = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    token = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    word = lambda: "".join(r.choice(["ver", "ant", "wort", "ung", "lich", "keit", "tion", "al", "in", "ter"]) for _ in range(r.randint(4, 7)))
    rows = [(i, " ".join(word() for _ in range(40)) + f" token={token('0123456789abcdef', 32)}") for i in range(300)]
    hidden = {1000 + i: token(sign, 40) for i in range(50)} | {1100 + i: "xdeadbeefdeadbeefQ" + token(sign, 30) for i in range(20)}
    rows += [(i, f"{word()} {t} {word()}") for i, t in hidden.items()] + [(2000 + i, " ".join(word() for _ in range(30))) for i in range(100)]
    docs = docs_of(spark, rows)
    found = {x["doc_id"]: [x["text"][s["start"] : s["end"]] for s in x["spans"] if s["kind"] == "format"] for x in secret_scan.scan(docs, secret_scan.learn(docs)).collect()}
    hits = sum(any(f in t and len(f) >= 30 for f in found[i]) for i, t in hidden.items())
    assert hits >= 0.95 * len(hidden)
    assert sum(map(len, (found[i] for i in range(300)))) <= 0.001 * 300 * 40 and not any(found[2000 + i] for i in range(100))


def test_base_columns_equal_sql(spark):
    # the base kinds, counted by DuckDB
    import duckdb

    docs = duckdb.sql("SELECT doc_id, coalesce(text, '') AS text FROM '/root/testdata/sf0.01/documents.parquet'")
    want = duckdb.sql(r"""
        SELECT doc_id, len(list_filter(regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda m: length(m) >= 12)) AS n_assign,
          len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda m: length(m) >= 18)) AS n_access,
          len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda m: length(m) >= 16)) AS n_hex FROM docs
    """).fetchall()
    out = queries.QUERIES["op4_secrets"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, want)) == sorted((x["doc_id"], x["n_assign"], x["n_access"], x["n_hex"]) for x in out)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i, *[0] * len(b)]
        for j, y in enumerate(b, 1):
            row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(8)
    terms = ["scum", "idiot", "moron", "pathetic", "worthless", "trash"]
    auto = toxicity.LexiconAutomaton([(t, False, 1.0) for t in terms])
    for _ in range(3000):
        w = list(r.choice(terms))
        for _ in range(r.randint(0, 3)):
            k = r.randint(0, len(w))
            w[k : k + r.randint(0, 1)] = r.choice(["", "a", "i", "t", "0"])
        w = "".join(w)
        near = [distance(w[1:], t[1:]) for t in terms if w[:1] == t[0] and distance(w[1:], t[1:]) <= toxicity.edits_allowed(len(t))]
        hit = auto.hit(w)
        assert (hit is not None) == bool(near) and (not near or hit[1] == min(near)), w
    stems = toxicity.LexiconAutomaton([("lowei", True, 2.0)])
    assert stems.hit("loweiabc") == (2.0, 0) and stems.hit("lowe") is None and stems.hit("xlowei") is None


def test_automaton_equals_plain_edit_distance_at_the_first_letter_too():
    r = random.Random(12)
    terms = ["scum", "idiot", "stupid", "pathetic", "worthless"]
    auto = toxicity.LexiconAutomaton([(t, False, 4.0) for t in terms], first_edits=True)
    allowed = {t: max(1, toxicity.edits_allowed(len(t))) for t in terms}
    for _ in range(3000):
        w = list(r.choice(terms))
        for _ in range(r.randint(0, 3)):
            k = r.choice([0, r.randint(0, len(w))])
            w[k : k + r.randint(0, 1)] = r.choice(["", "a", "s", "$", "1"])
        w = "".join(w)
        near = [d for t in terms if (d := distance(w, t)) <= allowed[t]]
        hit = auto.hit(w)
        assert (hit is not None) == bool(near) and (not near or hit[1] == min(near)), w
    scorer = toxicity.Scorer([(t, False, 4.0) for t in terms] + [("slum", False, 0.0)])
    for text in ("diot", "1diot", "ztupid", "$tupid", "**idiot**", "5cum", "$cum"):
        assert scorer.features(f"a {text} b")[0] > 0, text
    assert scorer.features("you slum *slum*") == [0.0, 0.0]
    assert toxicity.Scorer([("scum", False, 1.0)]).features("sum") == [0.0, 0.0]


def test_inflected_terms_can_be_misspelled(spark):
    r = random.Random(13)
    bad, plain = ["idiot", "idiots", "idiotic"], [f"w{i}" for i in range(200)]
    rows = [(" ".join([r.choice(plain) for _ in range(20)] + [r.choice(bad)] * (i % 3 == 0)), int(i % 3 == 0)) for i in range(300)]
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert ("idio", True) in {(t, stem) for t, stem, _ in terms} and {b for b in bad} <= {t for t, stem, _ in terms if not stem}
    scorer = toxicity.Scorer(terms)
    assert scorer.find("idi0t")[1] == scorer.find("1diots")[1] == 1 and scorer.find("idiotically")[1] == 0


def test_toxicity_is_learned_and_quotation_counts_less(spark):
    r = random.Random(9)
    bad, plain = ["idiot", "moron", "worthless"], [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [r.choice(plain) for _ in range(40)]
        if toxic:
            words[r.randrange(40)] = r.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(9001, None), (9002, ""), (9003, "you utter idiot"), (9004, 'he said "idiot" there'), (9005, "you wortless m0ron")]
    docs = docs_of(spark, rows)
    model = toxicity.learn(docs, spark.createDataFrame(labels + labels[:5], "doc_id long, quality int, toxic int"))
    assert {t for t, _, _ in model[0]} <= {*bad} | {b[:k] for b in bad for k in range(4, 9)}
    out = {x["doc_id"]: x["score"] for x in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((out[i] >= 0.5) == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert out[9001] == out[9002] < 0.1 and out[9003] >= 0.5 > out[9004] and out[9005] >= 0.5
    nothing = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert all(x["score"] < 0.5 for x in toxicity.score(docs, nothing).collect())


def test_pipeline_equals_plain_stages(spark, tmp_path):
    r = random.Random(10)
    line = lambda n: " ".join(f"w{r.randint(0, 3000)}" for _ in range(n))
    shared = line(12)
    rows = []
    for i in range(40):
        rows.append((i, f"{line(60)}\n{shared}\n{line(30)}", "en", f"s{i % 4}", 0))
    rows += [(50, rows[3][1].replace("w1", "v1", 1), "en", "s1", 0), (51, "spam " * 90, "en", "s1", 0), (52, None, "en", None, 0), (53, rows[5][1], "en", "s2", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = [x for x, s in zip(rows, repetition.text_stats([x[1] or "" for x in rows])) if s[0] >= 50 and 2 * s[4] <= s[0] and s[5] <= 0.4 * s[0] and s[6] <= 0.25 * s[0]]
    texts = {i: t for i, _, _, t in plain_line_dedup([(x[0], x[1]) for x in kept])}
    roots = plain_components(list(texts.items()))
    stay = [x for x in kept if roots[x[0]] == x[0]]
    sizes = defaultdict(int)
    for x in stay:
        sizes[x[3]] += len(texts[x[0]].split())
    target = plain_targets(sizes)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies = defaultdict(int)
    for x in out:
        copies[x["doc_id"]] += 1
        assert x["round_trip"] and x["n_tokens"] * 4 == len(x["ids"])
    for x in stay:
        rate = target[x[3]] / sizes[x[3]]
        assert copies.pop(x[0], 0) in (int(rate), int(rate) + 1)
    assert not copies


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_near_dedup_of_a_large_family_around_the_threshold(spark):
    # edits from few words, sizes apart: links inside and outside of what the anchor holds
    r = random.Random(9)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(150):
        own = list(base[: r.randint(70, 90)])
        for _ in range(r.randint(0, 6)):
            own[r.randrange(len(own))] = f"x{r.randint(0, 3)}"
        rows.append((i, " ".join(own + [f"t{k}" for k in range(r.choice([0, 0, 10, 25]))])))
    got = {x["doc"]: x["component"] for x in near_dedup.near_components(docs_of(spark, rows)).collect()}
    assert got == plain_components(rows)


def test_rare_labels_teach_their_terms(spark):
    # half a percent toxic, each with one of five terms; the sample holds a quarter of the clean texts
    r = random.Random(14)
    terms = ["zorgle", "blatherskite", "nincompoop", "muckraker", "dunderhead"]
    plain = lambda: " ".join(f"w{r.randint(0, 900)}" for _ in range(20))
    toxic = {i: terms[i // 200 % 5] for i in range(0, 20_000, 200)}
    rows = [(i, f"{plain()} {toxic[i]} {plain()}" if i in toxic else plain()) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(20_000)], "doc_id long, toxic int")
    learned, weights = toxicity.learn(docs, labels, sample=4000)
    assert set(terms) <= {t for t, _, w in learned if w}
    out = toxicity.score(docs, (learned, weights)).collect()
    assert sum(x["score"] >= 0.5 for x in out if x["doc_id"] in toxic) >= 98
    assert sum(x["score"] >= 0.5 for x in out if x["doc_id"] not in toxic) <= 5


def test_columns_named_like_temporary_ones_stay(spark):
    names = ["__stats", "made", "__size", "__source_size", "__target", "__copies", "__s", "__rate", "__copy", "__both", "__doc", "__content", "__dropped", "__lines", "own", "__quality", "verdict"]
    docs = spark.createDataFrame([(1, "a text of some words, long enough", "s")], "doc_id long, text string, source string")
    docs = docs.withColumns({n: F.lit(f"mine {n}") for n in names})
    mine = {n: f"mine {n}" for n in names}
    made = [
        repetition.quality(docs), mixing.mix(docs), line_dedup.dedup_lines(docs), near_dedup.keep_first(docs),
        bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
        secret_scan.scan(docs, None), toxicity.score(docs, ([], [-2.0, 0.0, 0.0])),
    ]
    for df in made:
        row = df.first().asDict()
        assert {n: row[n] for n in names} == mine


def test_empty_tables(spark):
    docs, labels = docs_of(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    assert secret_scan.scan(docs, secret_scan.learn(docs)).count() == 0
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 0
    one = docs_of(spark, [(1, "some text")])
    assert 0 <= toxicity.score(one, toxicity.learn(one, labels)).first()["score"] < 0.5


def test_other_queries_stay_without_optional_packages():
    code = (
        "import sys\nsys.modules['ahocorasick'] = None\nsys.modules['xxhash'] = None\n"
        "import warnings; warnings.simplefilter('ignore')\nimport __spark_entry__ as e\n"
        "assert len(e.queries()) >= 80 and not any(q.startswith('op') for q in e.queries())"
    )
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
