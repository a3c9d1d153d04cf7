"""Compression bands, the Merkle manifest and periodic runs against plain versions on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartage.llm import compression, merkle, periodic, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, tree string, runs string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, texts, first=0):
    rows = [(first + i, t, ("en", None)[i % 2], "s", len(t or ""), *["clash"] * 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward_texts():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdeéñ中#$|") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    texts = [None, "", " \t\n", "one", "a\x1cb c \x0b d", "line\nline\n\nline \nline\r\n x\n x", "x " * 40, "$%&|<>*#" * 30]
    for _ in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 300))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice(vocabulary) for _ in range(rng.randint(1, 25))]
            at = rng.randint(0, len(text))
            text[at:at] = (unit * 30)[: rng.randint(1, 120)]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in text))
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(200_000)))  # longer than one piece
    return texts


def plain_quality(text):
    w = split(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines, repeated = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            repeated += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def test_quality_counts_match_plain_rules(spark):
    texts = awkward_texts()
    out = compression.quality(frame(spark, texts)).collect()
    assert len(out) == len(texts)
    for row in out:
        want = plain_quality(texts[row["doc_id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert row["kept"] == (not row["base_failed"] and row["reason"] is None)


def test_bands_reject_repetition_and_noise_at_every_length():
    import base64

    import zstandard

    packer = zstandard.ZstdCompressor(level=compression.LEVEL)
    rng = random.Random(5)
    letters = "etaoinshrdlucmfwypvbgk"
    vocabulary = ["".join(rng.choices(letters, range(len(letters), 0, -1), k=rng.randint(2, 9))) for _ in range(2000)]
    for size in (200, 700, 3000, 20_000, 100_000):
        prose = " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(2000)], k=size)).encode()[:size]
        noise = base64.b64encode(rng.randbytes(size))[:size]
        repeated = (prose[:40] * size)[:size]
        assert compression.compression(prose, packer)[4] is None
        assert compression.compression(repeated, packer)[4] == "repetitive"
        if size > 500:
            assert compression.compression(noise, packer)[4] == "incompressible"
            mixed = prose[: size // 2] + noise[: size // 2]
            assert compression.compression(mixed, packer)[4] is not None or size < 4 * compression.CHUNK
    assert compression.compression(b"short", packer) == (None, 0, 0, 0, None)
    ratio = compression.compression(prose, packer)[0]
    assert ratio == pytest.approx(len(packer.compress(prose)) / len(prose), rel=0.01)


def test_quality_of_repeated_rows_null_ids_and_no_rows(spark):
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(60))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text)], "doc_id int, text string")
    assert {tuple(r)[1:] for r in compression.quality(docs).collect()} == {tuple(compression.quality(docs).first())[1:]}
    assert compression.quality(docs.limit(0)).count() == 0
    texts = awkward_texts()
    docs = frame(spark, texts)
    kept = compression.keep_by_compression(docs)
    assert kept.columns == docs.columns
    verdicts = {r["doc_id"]: r["kept"] for r in compression.quality(docs).collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, k in verdicts.items() if k}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(level):
    levels = [level]
    while len(level) > 1:
        level = [digest(*level[i : i + 16]) for i in range(0, len(level), 16)]
        levels.append(level)
    return levels


def climbed(levels, i):
    path = []
    for level in levels[:-1]:
        first = i // 16 * 16
        path.append((level[first:i], level[i + 1 : first + 16]))
        i //= 16
    return path


def plain_proofs(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append((row["doc_id"], plain_leaf(row, row["text"]), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for source in order:
        trees[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels[source] = grown([x[1] for x in trees[source]])
    upper = grown([levels[s][-1][0] for s in order])
    out = []
    for nth, source in enumerate(order):
        for i, (doc_id, leaf, row) in enumerate(trees[source]):
            path = climbed(levels[source], i) + climbed(upper, nth)
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            text = row["text"].translate(LOWER) if hit and row["text"] is not None else row["text"]
            root = plain_leaf(row, text)
            for left, right in path:
                root = digest(*left, root, *right)
            siblings = [d for left, right in path for d in left + right]
            out.append((doc_id, leaf, levels[source][-1][0], upper[-1][0], digest(*siblings), root, root == upper[-1][0]))
    return sorted(out, key=str)


def manifest_rows():
    """Sources of 1, 2, 16, 17, 33 and 300 rows, null and empty ones, null fields, repeated ids and rows."""
    rng = random.Random(3)
    sizes = {"one": 1, "two": 2, "run": 16, "more": 17, "Ä": 33, "hot": 300, None: 18, "": 5}
    sizes |= {f"s{i}": rng.randint(1, 3) for i in range(12)}
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "ABC", "abc", "Ünï Côde", "x" * 5000, f"Text {rng.random()}"])
            rows.append((len(rows), text, rng.choice([None, "en"]), source, rng.choice([None, 3]), *["clash"] * 4))
    rows += [(None, "A", None, "hot", None, *["clash"] * 4)] * 2 + [rows[40]] * 20 + [(7, "other", "en", "hot", 1, *["clash"] * 4)]
    rng.shuffle(rows)
    return rows


def test_manifest_matches_plain_trees(spark):
    docs = spark.createDataFrame(manifest_rows(), DOCS)
    got = sorted((tuple(r) for r in merkle.merkle_proofs(docs).collect()), key=str)
    assert got == plain_proofs(docs.collect())
    assert 0 < sum(not r[-1] for r in got) < len(got) / 2


def test_manifest_of_few_rows(spark):
    docs = spark.createDataFrame(manifest_rows(), DOCS)
    assert merkle.merkle_proofs(docs.limit(0)).count() == 0
    for few in (docs.where("source = 'one'"), docs.where("source in ('one', 'two')"), docs.where("source = 'run'")):
        got = sorted((tuple(r) for r in merkle.merkle_proofs(few).collect()), key=str)
        assert got == plain_proofs(few.collect())
    (alone,) = merkle.merkle_proofs(docs.where("source = 'one'")).collect()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_manifest_windows_hold_one_run(spark):
    plan = merkle.merkle_proofs(spark.createDataFrame(manifest_rows(), DOCS))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("run#" in line and "lag(" in line for line in windows)


def test_manifest_nodes_cover_every_level(spark, tmp_path):
    nodes = spark.range(300).select(F.lit("t").alias("tree"), F.lit(300).cast("long").alias("n"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    forest = merkle.Forest(nodes, str(tmp_path))
    levels = grown([digest(str(i)) for i in range(300)])
    found = {(r["level"], r["pos"]): r["digest"] for r in forest.nodes().collect()}
    assert found == {(n, i): d for n, level in enumerate(levels) for i, d in enumerate(level)}


def plain_runs(w):
    found = set()
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                run = w[i : i + length]
                if all(any(run[x] != run[x + d] for x in range(length - d)) for d in range(1, q)):
                    found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_words(rng, most=160):
    kinds = rng.choice([1, 2, 3, 5, 30, 400])
    w = [rng.randrange(kinds) for _ in range(rng.randint(0, most))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.randrange(kinds) for _ in range(rng.randint(1, 25))]
        at = rng.randint(0, len(w))
        w[at:at] = (unit * 90)[: rng.randint(1, 90)]
    return w


@pytest.mark.parametrize("rounds", [periodic.ROUNDS, 1, 0])
def test_runs_match_brute_force(monkeypatch, rounds):
    """However often segments are split before the scan, the runs are the same."""
    monkeypatch.setattr(periodic, "ROUNDS", rounds)
    rng = random.Random(rounds)
    for _ in range(600):
        w = made_words(rng)
        assert periodic.word_runs(np.array(w, np.int64)) == plain_runs(w), w


def test_splitting_leaves_only_frequent_words():
    rng = random.Random(4)
    for _ in range(200):
        w = np.array(made_words(rng, 400), np.int64)
        for a, b in periodic.segments(w):
            assert b - a >= 24 and np.unique(w[a:b], return_counts=True)[1].min() >= 3


def test_long_runs_are_found_whole():
    unit = np.random.default_rng(0).integers(0, 5000, 30_000)
    assert periodic.word_runs(np.resize(unit, 100_000)) == [(0, 100_000, 30_000)]
    assert periodic.word_runs(np.resize(unit, 89_999)) == []
    assert periodic.word_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def plain_digests(doc_id, text):
    w = split(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = None
    for run in runs:
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (
        len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4),
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest(),
    )


def test_digests_match_plain_version(spark, monkeypatch):
    monkeypatch.setattr(words, "CHUNK_BYTES", 64)
    rng = random.Random(9)
    texts = [t for t in awkward_texts() if len(t or "") < 5000]
    texts += [" ".join(f"w{x}" for x in made_words(rng)) for _ in range(150)]
    out = periodic.run_digests(frame(spark, texts)).collect()
    assert len(out) == len(texts) and sum(r["n_runs"] > 0 for r in out) > 40
    for row in out:
        assert tuple(row)[1:] == plain_digests(row["doc_id"], texts[row["doc_id"]])
    nameless = periodic.run_digests(spark.createDataFrame([(None, "a " * 30), (None, None)], "doc_id long, text string")).collect()
    assert [tuple(r)[1:] for r in nameless] == [plain_digests(None, "a " * 30), plain_digests(None, None)]
    assert periodic.run_digests(frame(spark, [])).count() == 0


def test_runs_and_collapsed_texts(spark):
    text = "start " + "tick tock " * 20 + "end"
    docs = frame(spark, [text, None, "  "])
    out = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    assert [tuple(r) for r in out[0]["runs"]] == [(1, 40, 2)] and out[0]["collapsed"] == "start tick tock end"
    assert out[1]["runs"] == out[2]["runs"] == [] and out[1]["collapsed"] == out[2]["collapsed"] == ""


def test_pieces_cut_between_words():
    raw = b"aa bbb\tcccc " * 50 + b"x" * 100
    for size in (1, 7, 64, 10_000):
        parts = list(words.pieces(raw, size))
        assert b"".join(parts) == raw and [w for p in parts for w in p.split()] == raw.split()
    assert list(words.pieces(b"")) == []
