"""Merkle manifest, toxicity and whitening against brute force, with the edge cases of each."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from histload.llm import merkle, toxicity, whitening
from histload.llm.queries import QUERIES
from histload.llm.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("rank", "n", "hash", "path", "leaf", "tampered", "block", "d0", "all", "score", "toxic", "grams", "x", "component")


def with_clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# ---------------------------------------------------------------- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        i //= 8
    return out


def brute_manifest(rows):
    """Of (doc_id, text, lang, source, n_chars) the rows that the query gives."""
    by_lang = defaultdict(list)
    for doc, text, lang, source, n in rows:
        digest = lambda t: sha(*map(field, (doc, source, lang, n, t)))  # noqa: B023, E731
        chosen = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        lower = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        by_lang[lang].append((doc is not None, doc, digest(text), digest(lower if chosen else text)))
    order = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: tree([leaf for _, _, leaf, _ in sorted(by_lang[lang], key=lambda r: (r[0], r[1] or 0, r[2]))]) for lang in order}
    top, out = tree([trees[lang][-1][0] for lang in order]), Counter()
    for at, lang in enumerate(order):
        for i, (_, doc, leaf, found) in enumerate(sorted(by_lang[lang], key=lambda r: (r[0], r[1] or 0, r[2]))):
            steps = path(trees[lang], i) + path(top, at)
            for before, after in steps:
                found = sha(before, found, after)
            root = top[-1][0]
            out[doc, leaf, trees[lang][-1][0], root, sha(*(a + b for a, b in steps)), found, found == root] += 1
    return out


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 600])
def test_manifest_is_that_of_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(10**6), f"Text {i} Ä ß" * (i % 3), "en" if rng.random() < 0.8 else rng.choice(["é", "z", "de", ""]), f"s{i}", i) for i in range(n)]
    out = merkle.documents(with_clashing(spark.createDataFrame(rows, DOCS)))
    assert Counter(map(tuple, out.collect())) == brute_manifest(rows)


def test_manifest_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FAN", 8)
    monkeypatch.setattr(merkle, "DIGITS", 1)  # blocks of eight: four passes
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, f"T{i}", "en", "s", i) for i in range(700)] + [(i, "x", "de", "s", 1) for i in range(3)]
    assert Counter(map(tuple, merkle.documents(spark.createDataFrame(rows, DOCS)).collect())) == brute_manifest(rows)


def test_manifest_of_nulls_copies_and_many_languages(spark):
    rows = [(None, "A", "en", None, None), (None, None, None, None, None), (5, "", "", "", 0), (9, None, "en", "s", 1), (9, None, "en", "s", 1)]
    rows += [(9, "Other", "en", "s", 1), (10, "word " * 50_000 + "END", None, "s", 3)] + [(i, "A b", f"l{i % 70}", "s", 3) for i in range(200)]
    out = merkle.documents(spark.createDataFrame(rows, DOCS))
    assert Counter(map(tuple, out.collect())) == brute_manifest(rows)
    assert merkle.documents(spark.createDataFrame([], DOCS)).isEmpty()


# ---------------------------------------------------------------- toxicity

INSULTS = ("grublok", "snarvelt", "quompish")


def toxic_corpus(n, seed, spoil=False):
    """Documents of which a fifth hold insults, spoilt by a letter if asked for."""
    rng, rows = random.Random(seed), []
    clean = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    for i in range(n):
        words, bad = rng.choices(clean, k=rng.randint(5, 200)), i % 5 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            insult = list(rng.choice(INSULTS))
            if spoil:
                insult[rng.randrange(1, len(insult) - 1)] = rng.choice("aeiou")
            words.insert(rng.randrange(len(words) + 1), "".join(insult))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def toxic_model():
    rows = toxic_corpus(1500, 1)
    return toxicity.fit(pa.array([r[1] for r in rows]), np.array([r[2] for r in rows]))


def caught(model, rows):
    found = model.scores(pa.array([r[1] for r in rows])) >= toxicity.THRESHOLD
    bad = np.array([r[2] for r in rows]) == 1
    return found[bad].mean(), found[~bad].mean()


def test_unseen_misspellings_are_caught(toxic_model):
    assert caught(toxic_model, toxic_corpus(500, 2))[0] > 0.95
    recall, alarms = caught(toxic_model, toxic_corpus(500, 3, spoil=True))
    assert recall > 0.7 and alarms < 0.02  # of words that no training text holds


def test_length_and_repetition_alone_are_not_toxic(toxic_model):
    rng = random.Random(9)
    clean = [t for _, t, bad in toxic_corpus(200, 4) if not bad]
    long = [" ".join(rng.choices(clean, k=60)) for _ in range(5)]
    repeated = [f"{w} " * 500 for w in clean[0].split()[:20]]
    assert (toxic_model.scores(pa.array(long + repeated)) < toxicity.THRESHOLD).mean() > 0.9
    assert toxic_model.scores(pa.array([long[0] + " grublok snarvelt quompish"]))[0] > 0.9


def test_scores_are_those_of_brute_force(toxic_model):
    weight = dict(zip(toxic_model.grams.tolist(), toxic_model.weights))

    def of_word(word):
        marked = b" " + word + b" "
        values = []
        for size in toxicity.GRAMS:
            for i in range(len(marked) - size + 1):
                h = marked[i]
                for c in marked[i + 1 : i + size]:
                    h = (h * 0x100000001B3 + c) % 2**64
                values.append(weight.get(int(toxicity.mixed(np.array([(h + size) % 2**64], np.uint64))[0]), 0.0))
        return sum(values), len(values)

    texts = ["", None, "Grublok", "a b c", "é ü grublok", " \t\n ", *[t for _, t, _ in toxic_corpus(30, 5, True)], " ".join(f"w{i}" for i in range(300)) + " snarvelt"]
    for text, found in zip(texts, toxic_model.scores(pa.array(texts))):
        words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
        n, means = -(-len(words) // toxicity.WINDOW), []
        for k in range(n):
            parts = [of_word(w) for w in set(words[k * len(words) // n : (k + 1) * len(words) // n])]
            means.append(sum(s for s, _ in parts) / max(sum(m for _, m in parts), toxicity.FULL))
        assert found == pytest.approx(1 / (1 + math.exp(-max(means, default=0.0) - toxic_model.offset)), abs=1e-9)


def test_toxicity_of_odd_rows(spark):
    rows = toxic_corpus(300, 6)
    docs = [(i, t, "en", "s", 1) for i, t, _ in rows] + [(None, "grublok", None, None, None), (7, "again", "en", "s", 5), (301, None, "en", "s", 0), (302, "", "en", "s", 0)]
    docs = with_clashing(spark.createDataFrame([*docs, (303, "grublok " + "w" * 70000, "en", "s", 1)], DOCS))
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows] + [(None, 1), (5, None), (7, 1), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.scores(docs, model).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.THRESHOLD) for r in out)
    assert len({r.score for r in out if r.doc_id in (301, 302)}) == 1
    assert toxicity.scores(docs.limit(0), model).isEmpty()
    for some in (labels.limit(0), labels.where("toxic = 1")):
        untaught = toxicity.train(docs, some)
        assert untaught.grams.size == 0 and toxicity.scores(docs, untaught).count() == len(out)
    assert toxicity.train(docs.limit(0), labels).grams.size == 0


def test_toxicity_on_held_out_labels(spark, sf_dir):
    out = QUERIES["op12_toxicity"](spark, sf_dir)
    rows = out.join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert out.count() == table(spark, sf_dir, "documents").count()
    bad, clean = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean([b > c for b in bad for c in clean]) > 0.8  # a tenth of the labels of sf0.1, where it is 0.99
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.05


# ---------------------------------------------------------------- whitening


def brute_whitening(x, most):
    n, centred = len(x), x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_is_that_of_eigenvectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    want, explained = brute_whitening(x.astype(float), 32)
    out = QUERIES["op13_whitening"](spark, sf_dir).toPandas()
    ids = [r.vec_id for r in rows]
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-8
    assert np.abs(np.sum(got * want, axis=0)) == pytest.approx(len(x))  # either sign, one for all rows
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert dict(zip(out.vec_id, out.deviation)) == dict(zip(ids, deviation.tolist()))
    assert out.groupby("component").explained.first().to_numpy() == pytest.approx(explained, rel=1e-9)
    assert (out.n == len(x)).all() and out.identity_error.nunique() == 1 and out.identity_error.max() < 1e-9


def check_vectors(a):
    d = a.shape[1]
    r = np.zeros((d, d))
    q = np.linalg.qr(a, mode="r")
    r[: len(q)] = q
    squares, v = whitening.right_singular(r)
    size = max(squares[0], 1e-300)
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-11
    assert np.abs(v.T @ a.T @ a @ v - np.diag(squares)).max() < 1e-11 * size
    want = np.linalg.svd(a, compute_uv=False)
    assert np.abs(np.sqrt(np.maximum(squares[: len(want)], 0)) - want).max() < 1e-13 * math.sqrt(size) * d


def test_solver_on_close_equal_and_absent_values():
    rng = np.random.default_rng(0)
    turned = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    check_vectors(rng.normal(size=(90, 24)))
    check_vectors(rng.normal(size=(5, 24)))
    check_vectors(np.repeat(np.eye(24), 3, axis=0) @ np.diag([1.0] * 12 + [2.0] * 12) @ turned)
    check_vectors(np.eye(24) @ np.diag(1 + 1e-9 * np.arange(24)) @ turned)
    check_vectors(np.eye(7))
    for _ in range(200):
        check_vectors(rng.integers(-2, 3, (rng.integers(1, 30), rng.integers(1, 16))).astype(float))


def test_small_values_keep_their_digits():
    rng = np.random.default_rng(1)
    scales = np.logspace(0, -9, 16)
    r = np.linalg.qr(rng.normal(size=(60, 16)) @ np.diag(scales), mode="r")
    squares, _ = whitening.right_singular(r)
    assert np.sqrt(squares) == pytest.approx(np.linalg.svd(r, compute_uv=False), rel=1e-9)


VECTORS = "vec_id long, embedding array<double>"


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-50, 50, 5)]) for i in range(40)]
    rows += [(0, rows[0][1]), (None, rows[1][1])]  # a repeated row, a null id
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [1.0, 2.0, float("nan"), 0.0, 0.0]), (104, [float("inf")] * 5), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    table = with_clashing(spark.createDataFrame(rows + odd, VECTORS)).repartition(7)
    out = whitening.whitened(whitening.scaled(table, "vec_id", "embedding"), 3).toPandas()
    assert Counter(out.vec_id.fillna(-1)) == Counter({-1: 3, **{i: 3 for i in range(1, 40)}, 0: 6})
    want, explained = brute_whitening(x.astype(float), 3)
    got = out[out.vec_id == 5].sort_values("component").whitened.to_numpy()
    assert np.abs(got) == pytest.approx(np.abs(want[5]), rel=1e-8)
    assert out.n.unique().tolist() == [42]


def test_whitening_without_spread_and_without_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(9)], VECTORS)
    assert whitening.whitened(whitening.scaled(same, "vec_id", "embedding")).isEmpty()
    assert whitening.whitened(whitening.scaled(same.limit(0), "vec_id", "embedding")).isEmpty()
    assert whitening.whitened(whitening.scaled(same.limit(1), "vec_id", "embedding")).isEmpty()
    flat = spark.createDataFrame([(i, [1.0, float(i), 3.0]) for i in range(9)], VECTORS)
    out = whitening.whitened(whitening.scaled(flat, "vec_id", "embedding")).collect()
    assert {r.component for r in out} == {1} and out[0].explained == pytest.approx(1)


def test_sums_of_squares_are_exact_or_null(spark):
    wide = [(i, [float(i % 3) * 2**38, 1.0]) for i in range(6)]
    out = whitening.whitened(whitening.scaled(spark.createDataFrame(wide, VECTORS), "vec_id", "embedding")).collect()
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v in wide]
    sums = [sum((6 * v[j] - sum(r[j] for r in x)) ** 2 for j in range(2)) for v in x]
    assert {r.vec_id: r.deviation for r in out} == {i: s if s < 2**63 else None for i, s in enumerate(sums)}


def test_many_triangles_meet_in_a_tree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=4) * 20]) for i in range(400)]
    table = spark.createDataFrame(rows, VECTORS).repartition(40)
    out = whitening.whitened(whitening.scaled(table, "vec_id", "embedding"))
    assert out.first().identity_error < 1e-10 and out.count() == 1600
