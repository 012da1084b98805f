"""Spelling variants, periodic runs and token counts against brute force."""

import hashlib
import itertools
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest

from clinical_cohort.llm import registry, runs, spelling, token_counts

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
on_driver_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()


def query(spark, name):
    registry.load_all()
    return registry.QUERIES[name](spark, SF).collect()


# --- periodic runs ---

def plain_runs(w, least=12):
    """Every lag's maximal stretches, the smallest lag of equal stretches first."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            b = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - b >= q and i - b + q >= least:
                out.setdefault((b - q, i), q)
            i += 1
    return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_all_short_texts():
    for least, n in itertools.product((2, 4, 6), range(11)):
        for w in itertools.product([b"a", b"b"], repeat=n):
            assert runs.runs(list(w), least) == plain_runs(w, least)


def test_runs_of_random_repetitions():
    random.seed(12)
    for _ in range(1500):
        letters, w = [b"a", b"b", b"c", b"d"][:random.randint(2, 4)], []
        while len(w) < random.randint(5, 120):
            w += random.choices(letters, k=random.randint(1, 9)) * random.randint(1, 6)
            if random.random() < 0.3:
                w += w[:random.randint(0, len(w))]
        least = random.choice([4, 5, 12, 12, 13])
        assert runs.runs(w, least) == plain_runs(w, least)


def test_runs_of_long_uniform_texts():
    x, y = [b"x"], [b"y"]
    assert runs.runs(x * 100_000) == [(0, 100_000, 1)]
    assert runs.runs(x * 30_000 + y + x * 30_000) == [(0, 30_000, 1), (30_001, 30_000, 1)]
    found = runs.runs((x * 100 + y) * 300)
    assert len(found) == 301 and (0, 30_300, 101) in found


def plain_words(text, key):
    w = (text or "").encode().split()
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected_runs(text, key):
    w = plain_words(text, key)
    found = plain_runs(w)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    kept = [x for i, x in enumerate(w) if not any(a + q <= i < a + n for a, n, q in found)]
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


@on_driver_data
def test_periodic_runs_query(spark, texts):
    small = [(k, t) for k, t in texts if len(t) < 20_000]
    got = {r.doc_id: tuple(r) for r in query(spark, "op12_periodic_runs")}
    assert set(got) == {k for k, _ in texts}
    for k, t in small:
        assert got[k] == expected_runs(t, k)
    assert any(got[k][1] for k, _ in small)


def test_runs_on_edges(edges, nothing):
    for r in runs.digest(edges).collect():
        assert r.n_runs == (1 if r.start is not None else 0) or r.n_runs > 1
    by_id = {r.doc_id: r for r in runs.digest(edges).collect()}
    assert by_id[2].n_runs == 0 and by_id[2].start is None and by_id[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert Counter(r.doc_id for r in runs.detect(edges).collect()) == Counter(r.doc_id for r in edges.collect())
    assert runs.digest(nothing).collect() == []


def test_runs_collapse(spark):
    docs = spark.createDataFrame([(1, "a " + "b c d " * 5 + "e"), (2, "x " * 12), (3, "x " * 11)], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.detect(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 15, 3)] and got[1].collapsed == "a b c d e"
    assert got[2].collapsed == "x" and got[3].runs == [] and got[3].collapsed.split() == ["x"] * 11


# --- spelling variants ---

def damaged_words(rows):
    total = Counter()
    for key, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{key}:{run}".encode()) if key is not None else 1
                total[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
                run = ""
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def edits(w, letters):
    for i in range(len(w) + 1):
        for c in letters:
            yield w[:i] + c + w[i:]
            if i < len(w):
                yield w[:i] + c + w[i + 1:]
        if i < len(w):
            yield w[:i] + w[i + 1:]


def expected_variants(words):
    letters = sorted({c for w in words for c in w})
    near = {w: {e for e in edits(w, letters) if e in words and e != w} for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return out


def test_variants_of_random_words(spark):
    random.seed(13)
    words = {}
    for _ in range(400):
        w = "".join(random.choices("abéd", k=random.randint(6, 9)))
        for _ in range(random.randint(1, 8)):
            words[w] = random.choice([5, 6, 20, 40, 170, 900, 5000])
            w = random.choice([e for e in edits(w, "abéd") if len(e) >= 6])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    formed = spelling.forms(frame).cache()
    got = formed.join(spelling.roots(formed), "word", "left").collect()
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root or r.word) for r in got} == expected_variants(words)
    assert any(r.root and r.root != r.form for r in got)


def test_keys_of_a_common_prefix_stay_apart(spark):
    """Words that share half their letters do not all meet: the join makes few rows besides the pairs."""
    random.seed(14)
    words = {"prefix" + "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3000)}
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    assert spelling.meeting(frame).count() < 3 * len(words)


@on_driver_data
def test_spelling_query(spark, texts):
    got = query(spark, "op11_spelling_variants")
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == expected_variants(damaged_words(texts))


def test_spelling_on_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    for least in (1, 2):
        got = {r.word: r.n for r in spelling.count(edges).where(f"n >= {least}").collect()}
        total = Counter()
        for k, t in rows:
            total.update(spelling.runs_of((t or "").encode(), k))
        assert got == {w: n for w, n in total.items() if n >= least}
    assert spelling.group(nothing).collect() == []


def test_damaged_runs():
    found = defaultdict(int)
    for k in range(2000):
        for w, n in spelling.runs_of("Straßen GARDENS gardens".encode(), k).items():
            found[w] += n
    assert found["gardens"] > 3900 and found["straßen"] > 1950
    assert 0 < sum(n for w, n in found.items() if len(w) == 6) < 60  # a deleted letter each
    assert not [w for w in found if len(w) < 6]
    both = spelling.runs_of(b"gardens ardens gardens rdens", 1, 5, damaged=1)  # a run that becomes another damaged one
    assert sum(both.values()) == 3 and both == Counter(damaged("gardens", 1)) + Counter(damaged("gardens", 1)) + Counter(damaged("ardens", 1))


def damaged(run, key):
    at = zlib.crc32(f"{key}:{run}".encode()) % len(run)
    return [run[:at] + run[at + 1:]]


# --- token counts ---

def library_counts(texts):
    from tokenizers import Tokenizer
    return [len(e.ids) for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    random.seed(15)
    parts = list("ab  \n\t.,'séÉ 1ßΣσİ") + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", " the", "\x1c", "\x85", "'ll", "'S", "　",
                                             "漢字", "é", "́", "ﬁ", "I'D", "2024", "\U0001f600", "\xa0", "​", "\x00", "²"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(3000)] + ["", "x" * 3000, "a1" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string").repartition(3)
    want = library_counts(texts)
    for size, cached in ((token_counts.FREQUENT, token_counts.CACHED), (0, 10), (50, 0)):
        got = {r.doc_id: r for r in token_counts.count(docs, WORD_BPE, size=size, cached=cached).collect()}
        assert [got[i].n_tokens for i in range(len(texts))] == want
        assert [got[i].n_bytes for i in range(len(texts))] == [len(t.encode()) for t in texts]
        assert (got[-1].n_bytes, got[-1].n_tokens, got[-1].over_limit) == (0, 0, False)


def test_frequent_pre_tokens(spark):
    docs = spark.createDataFrame([(i, "the the house, " + f"word{i}") for i in range(50)], "doc_id long, text string")
    table = token_counts.frequent(docs, size=3)
    assert len(table) == 3 and table[0] == b"the"
    assert len(token_counts.frequent(docs, sample_rows=5)) < len(token_counts.frequent(docs))


def test_no_pre_token_is_shuffled(spark, edges):
    plan = token_counts.count(edges, WORD_BPE)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


@on_driver_data
def test_token_counts_query(spark, texts):
    got = {r.doc_id: r for r in query(spark, "op13_token_counts")}
    for (k, t), n in zip(texts, library_counts([t for _, t in texts]), strict=True):
        assert tuple(got[k]) == (k, len(t.encode()), n, n > 2048)


def test_token_counts_on_edges(edges, nothing):
    assert Counter(r.doc_id for r in token_counts.count(edges, WORD_BPE).collect()) == Counter(r.doc_id for r in edges.collect())
    assert token_counts.count(nothing, WORD_BPE).collect() == []
