"""The methods against brute force, on random small input."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinical_cohort.llm import decontamination, graph, pfor, pieces, repeats, secrets, simhash, token_output, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**32 - 1)), max_size=3000), st.integers(0, 3000))
def test_pfor_round_trip(values, start):
    image = pfor.encode(np.array(values, np.uint32))
    assert pfor.decode(image).tolist() == values
    assert pfor.decode(image, start, start + 700).tolist() == values[start:start + 700]


def test_pfor_outliers_do_not_widen_a_block():
    values = np.full(1024, 7, np.uint32)
    plain = len(pfor.encode(values))
    values[::200] = 2**31
    assert len(pfor.encode(values)) == plain + 6 * 6  # six exceptions of six bytes


def test_encoder_equals_library():
    random.seed(3)
    encoder = token_output.Encoder(BPE)
    letters = list("ab  \n\t.,'sé 1") + ["<|endoftext|>", " the", "\x1c", "\x85", "'ll", "　", "漢", "<|", "|>"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 25))) for _ in range(4000)] + [None, "", " ", "  "]
    mark = "<|endoftext|>"
    texts += [mark, f"hello {mark} world", f"hello{mark}world", f"{mark} the", f"the {mark}", f"a{mark}{mark} b", f"a \n{mark}\n b", f"x <{mark}>"]
    ids, lengths = encoder.encode(pa.array(texts))
    plain = Tokenizer.from_file(BPE)  # the library as it is, no setting changed
    assert plain.encode(f"hello {mark} world", add_special_tokens=False).ids == [31373, 220, 50256, 995]
    want = [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_token_files(spark, tmp_path):
    random.seed(4)
    texts = {i: " ".join(random.choices(["the", "house,", "of", "1990", "naïve"], k=random.randint(0, 400))) for i in range(300)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    token_output.write(docs, str(tmp_path / "t"), BPE, shards=4)
    encoder, start = token_output.Encoder(BPE), 0
    got = {r.doc_id: r for r in token_output.read(spark, str(tmp_path / "t")).collect()}
    for i, t in sorted(texts.items()):
        ids = np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def brute_matches(items, ws, window=10):
    hit, found = [False] * len(ws), set()
    for item, iw in items:
        n = min(len(iw), window)
        for a in range(len(iw) - n + 1 if n else 0):
            for p in range(len(ws) - n + 1):
                if ws[p:p + n] == iw[a:a + n]:
                    found.add(item)
                    hit[p:p + n] = [True] * n
    return hit, found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9), min_size=1, max_size=5),
       st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=40), st.integers(2, 5))
def test_suffix_automaton(items, ws, window):
    named = [(str(i), x) for i, x in enumerate(items)]
    intervals, found = decontamination.SuffixAutomaton(named, window).stream(ws)
    hit = [False] * len(ws)
    for a, b in intervals:
        hit[a:b] = [True] * (b - a)
    assert (hit, found) == brute_matches(named, ws, window)


def test_blocks_of_items_give_the_same(spark):
    random.seed(5)
    word = lambda: random.choice("abcdefgh")
    items = spark.createDataFrame([(i, " ".join(word() for _ in range(random.randint(1, 14)))) for i in range(40)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(word() for _ in range(60))) for i in range(20)], "doc_id long, text string")
    one, many = (decontamination.match(docs, items, 4, n) for n in (10**6, 6))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert len(list(decontamination._blocks(items, 6, "text", "item_id"))) > 20
    for df in (one, many):  # one Python worker a task, however many blocks
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_clean_removes_spans_and_mostly_hit_documents(spark):
    item = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before it: {item.upper()}! " + "after " * 20, "x"), (2, item, "x"), (3, "clean", "x")],
                                 "doc_id long, text string, hits string")
    got = {r.doc_id: r.text for r in decontamination.clean(docs, items).collect()}
    assert got == {1: "Before it: ! " + "after " * 20, 3: "clean"}


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_admit_every_match(rule):
    samples = ["password = 'abcdefgh'", "API-KEY apikey: xxxxxxxxxx", "Secret=aaaaaaaaa", "AKIA" + "A" * 12, "f" * 40,
               "gho_" + "a" * 36, "xoxr-" + "1" * 12, "AIza" + "b" * 35, "sk_live_" + "c" * 16, "-----BEGIN EC PRIVATE KEY-----",
               "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12, "http://user:pass@host", "api_key=zzzzzzzzzzz"]
    query = secrets.trigram_query(rule.pattern)
    for s in samples:
        if re.search(rule.pattern, s):
            low = s.lower()
            assert all(any(all(g in low for g in grams) for grams in part) for part in query)
    assert bool(query) == (rule.kind != "hex")


def test_components(spark):
    random.seed(6)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    edges = [(a, b) for a, b in edges if a != b]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: r for x, r in root.items() if x != r}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprint_and_links(spark):
    def plain(text):
        w = text.encode().lower().split()
        grams = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        v = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        return v - (1 << 64) if v >> 63 else v
    for t in ("", "a", "A b C", "one two three four five six", "x " * 70_000):
        assert simhash.fingerprint(t.encode()) == plain(t)
    rng = np.random.default_rng(7)
    base = rng.integers(-2**63, 2**63 - 1, 60)
    near = [int(b) ^ int(np.bitwise_xor.reduce(np.left_shift(1, rng.choice(63, k, replace=False)))) for b in base for k in (1, 3, 4, 5)]
    fps = sorted({*map(int, base), *near, 0, -1, 15, 31})
    want = {(a, b) for a, b in combinations(fps, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (simhash.BLOCK, 3):
        got = {tuple(r) for r in simhash.links(frame, block=block).collect()}
        assert got <= want and _parts(got) == _parts(want)


def _parts(pairs):
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    out = {}
    for x in root:
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def test_links_of_a_ball_of_near_copies(spark):
    """Some thousand fingerprints around one: few more rows than fingerprints in each cell, and one group."""
    rng = np.random.default_rng(8)
    base = int(rng.integers(-2**62, 2**62))
    ball = {base ^ int(np.bitwise_or.reduce(np.left_shift(1, rng.choice(62, k, replace=False)))) for k in (1, 2, 2, 3, 3) for _ in range(500)}
    frame = spark.createDataFrame([(f,) for f in ball], "fp long")
    got = {tuple(r) for r in simhash.links(frame).collect()}
    arr = np.array(sorted(ball), np.int64).view(np.uint64)
    near = np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 4
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)}
    order = sorted(ball)
    assert _parts(got) == _parts({(order[a], order[b]) for a, b in want})
    assert len(want) > 200 * len(ball) and len(got) < 25 * len(ball)


def test_cells_are_cut_into_blocks(spark):
    members = spark.range(3000).selectExpr("id % 3 as cell", "id * 8 as fp").where("cell > 0 or fp < 3000")
    groups = simhash._blocks(members, 100)
    sizes = groups.groupBy("cell", "i", "j").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 2 * 150
    assert groups.where("i = j").select("cell", "fp").distinct().count() == members.count()
    given = simhash._forests(members, ["cell"], 4, block=200)  # larger cells are given back whole
    assert {(r.cell, r.n) for r in given.where("cell is not null").groupBy("cell").agg(F.count("a").alias("n")).collect()} == {(1, 1000), (2, 1000)}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30), max_size=4))
def test_anchors_are_equal_in_equal_windows(quarter, docs):
    window = 3 + quarter
    c = repeats.Chunk(docs, window)
    flat = [w for d in docs for w in d]
    seen = {}
    for start, a, half in zip(c.starts.tolist(), c.anchors().tolist(), c.halves().tolist(), strict=True):
        assert start <= a and a + c.base <= start + window and start <= half and half + 2 * c.base <= start + window
        assert seen.setdefault(tuple(flat[start:start + window]), (a - start, half - start)) == (a - start, half - start)


@pytest.mark.parametrize("window", [4, 5, 8])
def test_repeats(spark, window):
    random.seed(8)
    base = [random.choice("abcd") for _ in range(60)]
    docs = [(i, " ".join(base[random.randint(0, 30):random.randint(20, 60)] + random.choices("abcdef", k=random.randint(0, 40))))
            for i in range(120)]
    got = {r.doc_id: r for r in repeats.remove(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), window).collect()}
    seen = set()
    for i, t in docs:
        w = t.split()
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            x = tuple(w[a:a + window])
            if x in seen:
                gone[a:a + window] = [True] * window
            seen.add(x)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (
            len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(PIECES, 4)


def test_n_best_against_all_paths(encoder):
    v = encoder.vocabulary
    random.seed(9)

    def paths(s, end):
        if end == 0:
            return [(0.0, [])]
        out = []
        for start in range(end):
            p = v.pieces.get(s[start:end])
            if p is None and start + 1 == end:
                p = v.fallback(s[start])
            if p is not None:
                out += [(score + p[1], ids + list(p[0])) for score, ids in paths(s, start)]
        return out

    for _ in range(150):
        s = "".join(random.choices("the a  oé\nñx▁漢", k=random.randint(0, 8)))
        text = pieces.SPACE + s.replace(" ", pieces.SPACE)
        want = sorted((x for x, _ in paths(text, len(text))), reverse=True)[:4] if s else [0.0]
        got = encoder.n_best(encoder.segments(pa.array([s]))[0])
        assert [x for x, _ in got] == want
        assert len({tuple(i) for _, i in got}) == len(got)
        assert v.decode(got[0][1].tolist()).decode() == s.replace("▁", " ")


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
@example("a\x00b")
@example("\x00\x00the")
def test_pieces_round_trip(text):
    encoder = test_pieces_round_trip.__dict__.setdefault("e", pieces.Encoder(PIECES, 1))
    ids = encoder.n_best(encoder.segments(pa.array([text]))[0])[0][1]
    assert encoder.vocabulary.decode(ids.tolist()).decode() == text.replace("▁", " ")


def test_pieces_decode(spark):
    docs = spark.createDataFrame([(1, "Hello  wörld\nfoo\tbar "), (2, None), (3, "")], "doc_id long, text string")
    back = pieces.decode(pieces.encode(docs, PIECES), PIECES)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "Hello  wörld\nfoo\tbar ", 2: "", 3: ""}


def test_toxicity_separates_and_joins_agree(spark):
    random.seed(10)
    calm = ["house", "garden", "river", "morning", "letter", "window", "answer", "winter"]
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = random.choices(calm, k=random.randint(5, 60)) + (["snarlgrub" + random.choice(["ed", "ing", "er"])] if bad else [])
        random.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    d = spark.createDataFrame([*docs, (900, None), (901, "123 !")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(d, marks).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(400))
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in held]) == 1.0
    assert got[900].score == got[901].score and 0 <= got[900].score <= 1
    for shared in (0, 60):  # nothing is broadcast, or the most frequent contexts only
        joined = {r.doc_id: r for r in toxicity.score(d, marks, shared=shared).collect()}
        assert all(abs(joined[i].score - got[i].score) < 1e-9 for i in got)


class PlainKneserNey:
    """Interpolated Kneser-Ney over characters, straight from its definition; both classes share the lower orders."""

    def __init__(self, texts, order, without):
        self.order, self.n, every = order, {c: Counter() for c in (1, 0)}, set()
        for t, c, fold in texts:
            for w in self.words(t):
                every |= set(self.grams(w))
                if fold != without:
                    self.n[c].update(self.grams(w))
        self.types = {order: every}
        for k in range(order - 1, 0, -1):
            self.types[k] = {g[1:] for g in self.types[k + 1]}

    def words(self, text):
        return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()

    def grams(self, word):
        s = "\x02" * (self.order - 1) + word + "\x03"
        return [s[i:i + self.order] for i in range(len(s) - self.order + 1)]

    def before(self, s):
        return sum(1 for g in self.types[len(s) + 1] if g[1:] == s)

    def shared(self, s):
        if len(s) == 1:
            return self.before(s) / len(self.types[2])
        after = [x for x in self.types[len(s)] if x[:-1] == s[:-1]]
        total, d = sum(self.before(x) for x in after), toxicity.DISCOUNT
        return (max(self.before(s) - d, 0) + d * len(after) * self.shared(s[1:])) / total

    def likelihood(self, g, c):
        after = {x: n for x, n in self.n[c].items() if x[:-1] == g[:-1]}
        if not after:
            return self.shared(g[1:])
        d, total = toxicity.DISCOUNT, sum(after.values())
        return max(after.get(g, 0) - d, 0) / total + d * len(after) / total * self.shared(g[1:])

    def difference(self, word):
        out = 0.0
        for g in self.grams(word):
            if g in self.types[self.order]:
                out += math.log(self.likelihood(g, 1) / self.likelihood(g, 0))
            elif any(x[:-1] == g[:-1] for x in self.types[self.order]):  # both back off alike but for their weights
                back = []
                for c in (1, 0):
                    after = [n for x, n in self.n[c].items() if x[:-1] == g[:-1]]
                    back.append(toxicity.DISCOUNT * len(after) / sum(after) if after else 1.0)
                out += math.log(back[0] / back[1])
        return out

    def features(self, text):
        words = self.words(text)
        each = [self.difference(w) for w in words]
        grams = sum(len(self.grams(w)) for w in words)
        return (sum(each) / grams, max(each)) if words else (0.0, 0.0)


def test_differences_against_plain_kneser_ney(spark):
    random.seed(16)
    some = ["abba", "cabbage", "badge", "fade", "decaf", "beef", "cafe", "bed"]
    rows = [(i, " ".join(random.choices(some, k=6)) + (" grub" if i % 3 == 0 else ""), int(i % 3 == 0), 1 + i % 4) for i in range(24)]
    new = [(100, "abbagrub, Bed? zebra", None, 0), (101, "...", None, 0), (102, None, None, 0), (103, "fadebed bed bed", None, 2)]
    table = toxicity.model(toxicity.count(spark.createDataFrame(rows, "k long, t string, toxic int, fold int").repartition(3)))
    texts = spark.createDataFrame([(k, t, f) for k, t, _, f in rows + new], "k long, t string, without int")
    got = {r.k: (r.mean, r.top) for r in toxicity.differences(texts, table, folds=toxicity.FOLDS).collect()}
    for most in (40, 10**6):
        shared = toxicity._frequent(table, most, toxicity.ORDER)
        assert shared[-1] == (most > 40) and len(shared[1]) <= most
        for r in toxicity.differences(texts.where("without = 0"), table, shared).collect():
            assert (r.mean, r.top) == pytest.approx(got[r.k], abs=1e-9)
    for w in range(5):
        plain = PlainKneserNey([(t, c, f) for _, t, c, f in rows], toxicity.ORDER, w)
        for k, t, _, f in rows + new:
            if f == w:
                assert got[k] == pytest.approx(plain.features(t), abs=1e-9)
        g = next(iter(plain.types[toxicity.ORDER]))  # what follows a context, seen or not, sums to one
        letters = {x[-1] for x in plain.types[2]}
        for c in (1, 0):
            assert sum(plain.likelihood(g[:-1] + x, c) for x in letters) == pytest.approx(1.0)


def test_toxic_rows_outside_one_fold_are_learned(spark):
    random.seed(17)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    calm = ["house", "garden", "river", "morning", "letter", "window", "answer", "winter"]
    bad = {i for i in range(500) if fold(i) in (0, 2, 3, 4) and i % 9 == 0}
    docs = [(i, " ".join(random.choices(calm, k=20) + ["snarlgrub"] * (i in bad))) for i in range(500)]
    marks = [(i, int(i in bad)) for i in range(500)] + [(i, 1) for i in range(9000, 9900)]  # labels without a document
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"),
                                               spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    held = [i for i in range(500) if fold(i) == 0]
    assert [got[i].predicted for i in held] == [int(i in bad) for i in held]
    one = toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame([(i, 0) for i in range(100)] + marks[500:], "doc_id long, toxic int"))
    assert {round(r.score, 9) for r in one.collect()} == {0.5}
