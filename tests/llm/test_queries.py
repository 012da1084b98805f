"""The registered queries on the driver's smallest tables, against brute force where SQL has no form for them."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from clinical_cohort.llm import pieces, quality, registry, secrets, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
registry.load_all()


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()


def rows(spark, name):
    return {r.doc_id: r for r in registry.QUERIES[name](spark, SF).collect()}


def test_all_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_simhash(spark, texts):
    got = rows(spark, "op4_simhash_dedup")
    fp = np.array([simhash.fingerprint(t.encode()) for _, t in texts], np.int64)
    root = list(range(len(texts)))
    near = np.bitwise_count(fp.view(np.uint64)[:, None] ^ fp.view(np.uint64)[None, :]) <= 4
    for _ in range(len(texts)):
        new = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(texts))]
        if new == root:
            break
        root = new
    for i, (doc, _) in enumerate(texts):
        assert got[doc].fingerprint == f"{int(fp[i]) & (2**64 - 1):016x}" and got[doc].component_id == texts[root[i]][0]


def test_substring_dedup(spark, texts):
    got, seen = rows(spark, "op8_substring_dedup"), set()
    for doc, t in texts:
        w = t.encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            x = tuple(w[a:a + 20])
            if x in seen:
                gone[a:a + 20] = [True] * 20
            seen.add(x)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[doc].n_words, got[doc].n_removed, got[doc].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())


def test_tokens(spark, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = rows(spark, "op3_token_output"), 0
    for doc, text in texts:
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert tuple(got[doc]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_toxicity(spark, texts):
    got = rows(spark, "op1_toxicity")
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())


def test_sentencepiece(spark, texts):
    got = rows(spark, "op10_sentencepiece")
    v = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for doc, text in texts[:20]:
        best = v.viterbi(pieces.SPACE + text.replace(" ", pieces.SPACE))  # the whole text as one lattice
        assert got[doc].scores[0] == best[0][-1] and got[doc].round_trip
        assert got[doc].ids_crc32[0] == zlib.crc32(np.array(best[1], "<u4").tobytes()) and got[doc].n_tokens == len(best[1])
        assert got[doc].scores == sorted(got[doc].scores, reverse=True) and len(set(got[doc].ids_crc32)) == 4


def test_licenses_are_found(spark, texts):
    got = rows(spark, "op9_license_scan")
    for doc, text in texts:
        assert ("Apache-2.0" in got[doc].licenses) == ("Licensed under the Apache License, Version 2.0." in text)


WHITE = " \t\n\x0b\x0c\r"


def plain_quality(text):
    """The verdict of the quality rules, counted by hand."""
    w = [x for x in re.split(f"[{WHITE}]+", text) if x]
    n, lines = len(w), [x for x in text.split("\n") if x.strip(WHITE)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    repeated = {j for i in range(n - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    stops = {x for ws in quality.STOP_WORDS.values() for x in ws}
    return not (n < 10 or len(repeated) > 0.2 * n or not 1.5 * n <= sum(map(len, w)) <= 25 * n
                or sum(c in quality.SYMBOLS for c in text) > 0.1 * n
                or (n >= 50 and (sum(x in stops for x in w) < 0.01 * n or len(lines) - len(set(lines)) > 0.5 * len(lines))))


def plain_near_duplicates(texts):
    """Of each group of fingerprints within 4 bits the smallest id."""
    ids = sorted(texts)
    fp = np.array([simhash.fingerprint(texts[i].encode()) for i in ids], np.int64).view(np.uint64)
    near, seen, kept = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, set(), {}
    for i in range(len(ids)):
        if i not in seen:
            kept[ids[i]] = texts[ids[i]]
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += np.flatnonzero(near[x]).tolist()
    return kept


def plain_clean(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda t: [m.group().translate(LOWER) for m in word.finditer(t or "")]
    windows = set()
    for t in items:
        w = low(t)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes, out = {len(x) for x in windows}, {}
    for i, t in texts.items():
        w, places = low(t), [m.span() for m in word.finditer(t)]
        hit = sorted({k for n in sizes for j in range(len(w) - n + 1) if tuple(w[j:j + n]) in windows for k in range(j, j + n)})
        if len(hit) > 0.5 * len(w):
            continue
        gone = set()
        for k in hit:  # the words, and what is between two that are hit
            gone |= set(range(places[k][0], places[k + 1][0] if k + 1 in set(hit) else places[k][1]))
        out[i] = "".join(c for j, c in enumerate(t) if j not in gone) if hit else t
    return out


LOWER = {c: c + 32 for c in range(65, 91)}


def plain_redact(text):
    found = []
    for r in secrets.RULES:
        found += [m.span() for m in re.finditer(r.pattern, text) if len(m.group(r.group)) >= r.min_length]
    out, end = "", 0
    for a, b in sorted(found):
        if a >= end:
            out += text[end:a] + "[secret]"
        end = max(end, b)
    return out + text[end:]


def test_pipeline(spark, texts):
    """Every stage against a plain version of it, on the rows that the stage before kept."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), dict(texts)
    items = [t for t, in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    plain = {"quality_rules": lambda d: {i: t for i, t in d.items() if plain_quality(t)}, "near_duplicates": plain_near_duplicates,
             "decontaminate": lambda d: plain_clean(d, items), "secret_scan": lambda d: {i: plain_redact(t) for i, t in d.items()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        now = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = plain[name](kept)
        assert {i: t for i, (t, _) in now.items()} == kept
        assert all(n == len(t) for t, n in now.values())
    out = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    v = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert {i: v.decode(x).decode() for i, x in out.items()} == kept
