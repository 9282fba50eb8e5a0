"""The registered queries against SQL, or against brute force on the whole tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from histload.llm import jaccard_join
from histload.llm.oracles import ORACLES
from histload.llm.queries import QUERIES, TOKENIZER
from histload.llm.tables import table

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir) / t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_all_are_registered():
    known = registry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(known) and known["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(registry.oracle_sql()) and "pipeline" not in registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    got, want = QUERIES[name](spark, sf_dir), duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = Counter(tuple(r) for r in got.select(*columns).collect())
    assert rows and rows == Counter(want.fetchall())


def test_bpe(spark, sf_dir, texts, tokenizer):
    rows = QUERIES["op3_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_quality(spark, sf_dir):
    kept = {r.doc_id: r.keep for r in QUERIES["op5_quality"](spark, sf_dir).collect()}
    judged = Counter((r.quality, kept[r.doc_id]) for r in table(spark, sf_dir, "labels").collect())
    good, bad = judged[1, True] + judged[1, False], judged[0, True] + judged[0, False]
    assert judged[1, True] >= 0.99 * good and judged[0, False] >= 0.9 * bad


def test_simhash(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in QUERIES["op6_simhash"](spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    order, by_text = sorted(texts, reverse=True), {}
    for i, doc in enumerate(order):
        r, text, after = rows[doc], texts[doc], order[(i + 1) % len(order)]
        n = len(text) // 3
        edited = text[: len(text) - n] + texts[after][:n]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        differing = (int(r.fingerprint, 16) ^ int(rows[after].fingerprint, 16)).bit_count()
        assert r.near_next == pytest.approx(1 - differing / 64)
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.98
    prints = np.array(sorted({int(r.fingerprint, 16) for r in rows.values()}), np.uint64)
    near = {int(p): int((np.bitwise_count(prints ^ p) <= 3).sum()) - 1 for p in prints}
    assert all(r.n_near == near[int(r.fingerprint, 16)] for r in rows.values())


def _base(text):
    word = "".join
    keyword = "|".join(word(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets(spark, sf_dir, texts):
    rows = QUERIES["op7_secrets"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _base(texts[r.doc_id])
        written = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == written


def test_packing(spark, sf_dir, texts, tokenizer):
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in QUERIES["op8_packing"](spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        total += len(ids)
        for n, p in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (p.piece, p.start) == (n, at)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            assert n == 0 or p.length == 1024
            at += p.length
        assert at == len(ids) and (len(ids) > 1024 or len(pieces[doc]) == 1)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.01 * -(-total // 1024)


def test_language_model(spark, sf_dir, texts):
    rows = QUERIES["op9_language_model"](spark, sf_dir).collect()
    assert Counter(r.n_words for r in rows) == Counter(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts.values())
    assert sum(r.log_probability for r in rows) / sum(r.n_words for r in rows) > np.log(1 / 1024) + 0.2


def shingle_sets(texts, words):
    out = {}
    for doc, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        out[doc] = {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()
    return out


def brute_components(sets, num, den):
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders, common = defaultdict(list), Counter()
    for d in sorted(sets):
        for s in sets[d]:
            for other in holders[s]:
                common[other, d] += 1
            holders[s].append(d)
    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: find(d) for d in sets}


def test_jaccard_join(spark, sf_dir, texts):
    sets = shingle_sets(texts, 4)
    want = brute_components(sets, 85, 100)
    rows = QUERIES["op10_jaccard_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {d: (len(s), want[d]) for d, s in sets.items()}


@pytest.mark.parametrize("rare", [False, True])
def test_jaccard_join_of_shared_passages(spark, monkeypatch, rare):
    """Texts that share passages without linking, and some that just do, by either way to pairs."""
    rng = random.Random(4)
    passages = [" ".join(f"p{i}w{j}" for j in range(25)) for i in range(5)]
    docs = {}
    for d in range(0, 400, 2):
        parts = rng.sample(passages, rng.randint(0, 5)) + [" ".join(f"d{d}w{j}" for j in range(rng.randint(0, 60)))]
        docs[d] = " ".join(parts)
        found = docs[d].split()
        for _ in range(rng.randint(0, 3)):
            if found:
                found[rng.randrange(len(found))] = f"x{rng.randrange(9)}"
        docs[d + 1] = " ".join(found)
    if rare:
        monkeypatch.setattr(jaccard_join, "PAIRS_PER_ROW", 0)
        monkeypatch.setattr(jaccard_join, "FEW", 10**9)
        monkeypatch.setattr(jaccard_join, "_pairs_within", None)
    sets = shingle_sets(docs, 4)
    want = brute_components(sets, 85, 100)
    assert len(set(want.values())) < 0.8 * len(docs)
    rows = jaccard_join.near_components(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), 4, 85, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {d: (len(s), want[d]) for d, s in sets.items()}


@settings(max_examples=300, deadline=None)
@given(common=st.integers(1, 400), room=st.integers(0, 120), in_a=st.integers(0, 120), num=st.sampled_from([80, 85, 95]))
def test_linked_sets_share_a_rare_shingle(common, room, in_a, num):
    """In one order of all shingles, the first of two linked sets meet."""
    in_a = min(in_a, room)
    if 100 * common < num * (common + room):
        return
    ranks = random.Random(common * 1000 + room).sample(range(10000), common + room)
    both, only = ranks[:common], ranks[common:]
    first = [set(sorted(s)[: len(s) + num * len(s) // -100 + 1]) for s in (both + only[:in_a], both + only[in_a:])]
    assert first[0] & first[1]


def test_pipeline(spark, sf_dir, texts):
    docs, before = table(spark, sf_dir, "documents"), dict(texts)
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        if name == "best_fit_packing":
            rows = out.collect()
            assert {r.doc_id for r in rows} == set(before)
            filled = Counter()
            for r in rows:
                filled[r.sequence_id] += r.length
            assert max(filled.values()) <= 1024
            break
        assert out.dtypes == docs.dtypes
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_classifier":
            assert sum(labels[d] == 1 for d in set(before) - set(after) if d in labels) <= 0.01 * len(labels)
            assert all(after[d] == before[d] for d in after)
        elif name == "line_dedup":
            lines = Counter(x for t in after.values() for x in t.split("\n"))
            assert set(lines) <= {x for t in before.values() for x in t.split("\n")}
            assert {x for t in before.values() for x in t.split("\n") if x.strip()} == {x for x in lines if x.strip()}
        elif name == "jaccard_join":
            want = brute_components(shingle_sets(before, 5), 80, 100)
            assert after == {d: before[d] for d in before if want[d] == d}
        elif name == "secret_scans":
            assert set(after) == set(before)
            for d, t in after.items():
                assert not _base(t) and (t == before[d] or "[SECRET]" in t)
        docs, before = out, after
