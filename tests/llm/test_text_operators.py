"""Line dedup, rules, fingerprints, chat and tokens against plain versions, with odd inputs."""

import gc
import hashlib
import random
import struct
import weakref

import pytest
import xxhash
from pyspark.sql import functions as F

from switchback.llm import bpe, chat, line_dedup, repetition, syncmers

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, pos int, hash string, quality string"
WHITE = "\t\n\x0b\x0c\r "


def docs_of(spark, texts):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "x", 1, "y", "z") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


ODD = [
    (4, None), (1, ""), (2, "same line of text\nother line here\nsame line of text"), (3, "  SAME line of text\t\n\n\nshort"), (3, "  SAME line of text\t\n\n\nshort"),
    (9, "ÉTÉ à la ligne\nsame line of text"), (10, "été à la ligne\nsame line of text\n" + "long " * 5000), (None, "same line of text\nlast"), (11, "\n\n"),
]


def plain_line_dedup(texts, least=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(WHITE).translate(lower)
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t in texts:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(key(x), order(i)) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_equals_the_plain_version(spark):
    for texts in (ODD, []):
        out = line_dedup.dedup_lines(docs_of(spark, texts), salts=2)
        got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()]
        assert sorted(got, key=str) == sorted(plain_line_dedup(texts), key=str)
        assert {"lang", "pos", "hash"} <= set(out.columns)


def test_line_bitmaps_hold_runs_and_no_text(spark):
    bitmaps = line_dedup.keep_bitmaps(docs_of(spark, [(1, "a" * 12 + "\nb\n" + "c" * 12), (2, "x\n" + "a" * 12 + "\n" + "c" * 12 + "\ny")]))
    assert bitmaps.columns == ["doc", "content", "dropped"]
    assert [tuple(x) for x in bitmaps.first()["dropped"]] == [(1, 2)]


def longest_by_pairs(words):
    n, out = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def covered_by(lengths):
    marked = set()
    for i, k in enumerate(lengths):
        marked.update(range(i, i + k))
    return len(marked)


def test_suffix_arrays_equal_pairwise_comparison(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice("abcd"[: r.randint(1, 4)]) for _ in range(r.randint(0, 60))) for _ in range(60)] + ["", "one", " \n x  y\n x  y\n"]
    for text, stats in zip(texts, repetition.text_stats(texts)):
        words = text.split()
        long = longest_by_pairs(words)
        windows = covered_by([3 if k >= 3 else 0 for k in long])
        repeats = [k if k >= repetition.REPEAT_WORDS else 0 for k in long]
        assert stats[0] == len(words) and stats[4:] == (windows, covered_by(repeats), max(repeats, default=0))


def test_rules_keep_clean_texts_and_reject_repeats(spark):
    r = random.Random(6)
    clean = " ".join(f"w{r.randint(0, 5000)}" for _ in range(300))
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [(1, clean), (2, "spam " * 400), (3, None), (4, ""), (5, passage + " " + clean[:200] + " " + passage), (6, "| a " * 10 + clean), (7, "x#" * 200 + clean)]
    table = "\n".join(f"| row{i} | {r.randint(0, 10**6)} | {r.randint(0, 10**6)} |" for i in range(60))  # symbols alone reject nothing
    texts += [(8, table), (9, clean[:600] + " " + clean[:600])]
    out = {x["doc_id"]: x["quality"] for x in repetition.quality(docs_of(spark, texts)).collect()}
    assert {k for k, v in out.items() if v["kept"]} == {1, 6, 7, 8} and out[3]["base_failed"] and out[5]["longest_repeat"] == 40
    assert out[2]["n_repeat_words"] == 400 and out[7]["n_symbols"] == 200
    assert repetition.quality(docs_of(spark, [])).count() == 0


def plain_units(text):
    import regex

    return regex.findall(r"(?V1)[\p{Latin}--[aeoAEO]]+[aeoAEO]?|[^\x20\x09-\x0D]", text)


def plain_anchors(text, k=syncmers.K, s=syncmers.S):
    """Places of the k-mers whose least s-mer hash is at an edge, by the same hashes in plain Python."""
    h = [xxhash.xxh64_intdigest(u.encode(), 42) for u in plain_units(text)]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    smers = []
    for i in range(len(h) - s + 1):
        x = h[i]
        for j in range(1, s):
            x = xxhash.xxh64_intdigest(struct.pack("<Q", h[i + j]), xxhash.xxh64_intdigest(struct.pack("<Q", x), 42))
        smers.append(signed(x))
    out = []
    for i in range(len(h) - k + 1):
        inner = smers[i : i + k - s + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out or ([0] if h else [])


def test_anchors_equal_plain_version(spark):
    r = random.Random(17)
    texts = [(i, "".join(r.choice("abcdefgot  AEz9.漢é\n") for _ in range(r.randint(0, 120)))) for i in range(60)] + [(90, None), (91, " \n"), (92, "xyz" * 50_000)]
    for x in syncmers.with_anchors(docs_of(spark, texts), "text", "at", "anchors").collect():
        assert x["at"] == plain_anchors(x["text"] or ""), x["text"]
        assert len(x["anchors"]) == len(x["at"])


def test_likeness_after_small_changes(spark):
    r = random.Random(18)
    latin, han = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(600)), "".join(chr(r.randint(0x4E00, 0x5FFF)) for _ in range(600))
    words = " ".join("".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(60))
    pairs = [(latin, latin[:10] + "q" + latin[10:]), (han, han[:10] + "界" + han[10:]), (words[:199], words[:203]), (words, words), ("", None), (words, han)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    both = syncmers.with_anchors(syncmers.with_anchors(df, "a", "at_a", "x"), "b", "at_b", "y")
    rows = {r["i"]: r for r in both.withColumn("near", syncmers.likeness(F.col("x"), F.col("y"))).collect()}
    for x in rows.values():
        a, b = set(x["x"]), set(x["y"])
        assert x["near"] == (len(a & b) / len(a | b) if a | b else 1.0)
    assert [rows[i]["near"] > 0.7 for i in range(6)] == [True] * 5 + [False] and rows[3]["near"] == rows[4]["near"] == 1.0


def test_anchors_are_context_free_and_equal_for_equal_texts(spark):
    r = random.Random(7)
    words = [f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randint(0, 99)}" for _ in range(400)]
    body, head, tail = " ".join(words), " ".join(words[:30]) + " zz ", " yy " + " ".join(words[5:60])
    texts = [(1, body), (2, head + body), (3, body + tail), (4, body), (5, None), (6, "ab"), (7, "")]
    out = {x["doc_id"]: x for x in syncmers.with_anchors(docs_of(spark, texts), "text", "at", "anchors").collect()}
    assert out[1]["anchors"] == out[4]["anchors"] and out[5]["anchors"] == [] and len(out[6]["anchors"]) == 1
    assert set(out[1]["anchors"]) <= set(out[2]["anchors"]) and set(out[1]["anchors"]) <= set(out[3]["anchors"])
    shift = len(plain_units(head + body)) - len(plain_units(body))
    moved = [(a, h) for a, h in zip(out[2]["at"], out[2]["anchors"]) if a >= shift]
    assert [(a - shift, h) for a, h in moved] == list(zip(out[1]["at"], out[1]["anchors"]))
    units = len(plain_units(body))
    assert 0.3 < len(out[1]["at"]) / units < 0.5  # two of five places


def test_edited_texts_and_neighbours(spark):
    texts = [(5, "fifth text " * 30), (1, "first text, quite short"), (3, None), (None, "no id"), (2, "second " * 9), (2, "second " * 9), (8, "日本語のテキスト" * 4)]
    order = sorted(texts, key=lambda x: (2**63 if x[0] is None else x[0], x[1] or ""))
    want = []
    for k, (_, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        want.append(t[: len(t) - q] + following[:q])
    for parts in (1, 3):
        got = syncmers.fingerprint_edits(docs_of(spark, texts), parts).collect()
        assert sorted(x["edited"] for x in got) == sorted(want)
    assert syncmers.fingerprint_edits(docs_of(spark, []), 4).count() == 0
    assert syncmers.fingerprint_edits(docs_of(spark, [(1, "alone " * 20)]), 4).first()["edited"] == "alone " * 15 + ("alone " * 20)[:30]


def test_shared_anchors_line_up(spark):
    r = random.Random(8)
    body = " ".join(f"{r.choice('bcdfg')}{r.randint(0, 999)}" for _ in range(200))
    rows = spark.createDataFrame([("intro words here " + body, body)], "a string, b string")
    rows = syncmers.with_anchors(syncmers.with_anchors(rows, "a", "at_a", "h_a"), "b", "at_b", "h_b")
    pairs = rows.select(syncmers.shared_anchors(F.col("at_a"), F.col("h_a"), F.col("at_b"), F.col("h_b"))).first()[0]
    assert len(pairs) > 20 and len({p["a"] - p["b"] for p in pairs}) == 1


TURNS = "conv_id long, turn long, role string, text string, formatted string, place int"


def test_chat_round_trip_and_mask(spark):
    hard = ["\\### Assistant: </turn> ok", "<|end|>", "<\\|end|>", "\\<|says|>\\\\", "a<", "|b", "", None, "<|<|\n|>"]
    r = random.Random(9)
    rows = [(c, t if c % 2 else None, r.choice(["user", "assistant", "assistant", "system", None, "<|turn|>"]), r.choice(hard), "f", 1) for c in range(8) for t in range(9)]
    rows += rows[:3] + [(None, 1, "user", "no conversation", "f", 1)]
    made = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    out = made.select("conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("t"), chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("m"))
    escape = lambda s: (s or "").replace("\\", "\\\\").replace("<|", "<\\|")
    for x in out.collect():
        own = [v for v in rows if v[0] == x["conv_id"]]
        own.sort(key=lambda v: (v[1] is None, v[1] or 0, escape(v[2]), escape(v[3])))
        assert [tuple(t) for t in x["t"]] == [(v[2] or "", v[3] or "") for v in own]
        assert x["m"] == [v[3] or "" for v in own if v[2] == "assistant"]
        blocks = sum(1 for a, b in zip([None, *own], own) if a is None or (a[2] or "") != (b[2] or ""))
        assert x["formatted"].count(chat.START) == blocks == x["formatted"].count(chat.END)
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.Encoder(bpe.Vocabulary.load(f.read()), tokenizers.PATTERN)


def noise(r, n):
    return "".join(r.choice(["a", "b ", " ", "\n", "the", "é", "'s", "12", "!?", " x", "日", "\t", "😀", "<|endoftext|>"]) for _ in range(n))


def test_tokens_equal_the_public_library(spark, encoder):
    import tiktoken

    plain = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})
    r = random.Random(10)
    texts = [noise(r, r.randint(0, 40)) for _ in range(400)] + ["a" * 5000, " " * 300 + "x", "x\x1cy\x85z᠎", "ab" * 3000]
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    docs = docs_of(spark, [*enumerate(texts), (-1, None), (-1, None)])
    out = bpe.decode(bpe.encode(docs, path, tokenizers.PATTERN), path, tokenizers.PATTERN).withColumn("n", bpe.n_tokens(F.col("ids")))
    for x in out.collect():
        ids = bpe.unpack(bytes(x["ids"])).tolist()
        assert ids == plain.encode_ordinary(x["text"] or "") and x["n"] == len(ids) and bytes(x["decoded"]).decode() == (x["text"] or "")
    both = bpe.round_trip(docs, path, tokenizers.PATTERN)
    assert both.select("ids", "decoded").exceptAll(out.select("ids", "decoded")).count() == 0
    assert bpe.encode(docs_of(spark, []), path, tokenizers.PATTERN).count() == 0


def test_prefix_states_extend_and_edits_are_local(spark, encoder):
    v, r = encoder.vocabulary, random.Random(11)
    for _ in range(50):
        piece = bytes(r.choice(b"abcthe") for _ in range(r.randint(1, 30)))
        k = r.randint(0, len(piece))
        assert v.extend(piece, v.extend(piece[:k], [])) == v.extend(piece, [])
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    texts = [(i, noise(r, 30)) for i in range(150)]
    edits = []
    for i, t in texts[:120]:
        a = r.randint(0, len(t))
        edits.append((i, a, r.randint(a, len(t)), noise(r, 3)) if i % 3 else (i, len(t), len(t), noise(r, 3)))
    docs = docs_of(spark, texts)
    encoded = bpe.encode(docs, path, tokenizers.PATTERN).select("doc_id", "text", "ids")
    changed = bpe.apply_edits(encoded, spark.createDataFrame(edits, "doc_id long, start int, end int, new string"), path, tokenizers.PATTERN)
    new = dict(texts) | {i: dict(texts)[i][:a] + n + dict(texts)[i][b:] for i, a, b, n in edits}
    for x in changed.collect():
        assert x["text"] == new[x["doc_id"]] and bytes(x["ids"]) == encoder.encode(x["text"])


def test_digest_of_ids_is_of_little_endian_words(encoder):
    ids = bpe.unpack(encoder.encode("hello world")).tolist()
    assert hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).digest() == hashlib.sha256(encoder.encode("hello world")).digest()


def test_words_that_share_a_beginning_are_not_encoded_anew(encoder):
    ranks, r = encoder.vocabulary.ranks, random.Random(12)
    stems = ["".join(r.choice("abcdehinorstuéñ") for _ in range(12)) for _ in range(40)]
    v, forward = bpe.Vocabulary(ranks), bpe.Vocabulary(ranks)
    scanned = []
    plain_extend = v.extend
    v.extend = lambda piece, last: scanned.append(piece) or plain_extend(piece, last)
    for _ in range(2000):
        piece = (" " + r.choice(stems) + "".join(r.choice("abcdehinorstuéñ") for _ in range(r.randint(1, 4)))).encode()
        assert v.encode_piece(piece) == forward.walk_back(forward.extend(piece, []))
    assert not scanned and len(v._last) < 4 * 2000
    for n in (bpe.SHORT_PIECE - 1, bpe.SHORT_PIECE, bpe.SHORT_PIECE + 1, 500):
        piece = bytes(r.choice(b"abcthe") for _ in range(n))
        assert v.encode_piece(piece) == forward.walk_back(forward.extend(piece, []))


def test_an_encoder_is_freed_without_collecting_cycles(encoder):
    gc.disable()
    try:
        own = bpe.Encoder(bpe.Vocabulary(encoder.vocabulary.ranks), tokenizers.PATTERN)
        own.decode(own.encode("some words, " + "ab" * 40))
        left = weakref.ref(own.vocabulary), weakref.ref(own)
        del own
        assert left[0]() is None and left[1]() is None
    finally:
        gc.enable()
