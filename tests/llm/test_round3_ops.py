"""Language identification, whitening and importance resampling against brute
force and odd rows."""

import collections
import functools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.llm import (
    decontaminate, importance, language_id, line_dedup, near_dup, quality_rules, queries, secret_scan, site_style_tree,
    source_mix, suffix_tree, token_rollup, url_filter, whitening,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"mot{i}" for i in range(60_000))
ODD = [(1, None, "en", None, None), (2, "", "en", "s", 0), (3, " \n\t 12 !", "en", "s", 4), (None, "une phrase de mots", "fr", "s", 1),
       (None, "une phrase de mots", "fr", "s", 1), (4, "one two three", None, "t", 7), (4, "one two three", "en", "t", 7),
       (7, LONG, "fr", "s", 1), (8, "ÉTÉ İstanbul Straße 中文", "de", "s", 1)]


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------- language id

def slow_grams(text):
    text = " " + "".join(c if c.isalpha() else " " for c in pa.compute.utf8_lower(pa.scalar(text or "")).as_py()) + " "
    out = collections.Counter()
    for n in range(1, language_id.LONGEST + 1):
        for i in range(len(text) - n + 1):
            g = text[i:i + n]
            if g.strip() and (n < 3 or " " not in g[1:-1]):
                out[g] += 1
    return out


def fast_grams(text):
    return np.concatenate([b for _, b, _ in language_id.grams(pa.array([text], pa.string()))])


@pytest.mark.parametrize("piece", [3, 4, 5, 7, 11, 1 << 17])
def test_grams_are_those_of_the_whole_text(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ("the cat sat", "a", " ", "ab, Cé dEf  g", "1a2bb", "x" * 23, "ab cd ef gh ij kl"):
        want = slow_grams(text)
        got = fast_grams(text)
        assert len(got) == sum(want.values())
        by_gram = collections.Counter()
        for g, n in want.items():
            # A gram alone: the buckets of the text made of it, minus those of its parts.
            by_gram[g] += n
        assert sorted(collections.Counter(got.tolist()).values()) == sorted(
            collections.Counter(fast_grams_of(want)).values())


def fast_grams_of(want):
    """Bucket of every gram, worked out by the hash's definition."""
    from tierwise.llm.common import mix
    out = []
    for g, n in want.items():
        key = [np.uint64(ord(c) + 1 if c != " " else 1) for c in g]
        with np.errstate(over="ignore"):
            h = np.array([key[0] * np.uint64(0x9E3779B97F4A7C15)], np.uint64)
            for k in key[1:]:
                h = mix(h) + np.array([k * np.uint64(0xC2B2AE3D27D4EB4F)], np.uint64)
            bucket = int(mix(h)[0] >> np.uint64(48)) % language_id.BUCKETS
        out += [bucket] * n
    return out


def test_language_matches_brute_force_bayes(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None:
            own = fast_grams(r.text).tolist()
            counts[r.lang].update(own)
            docs[r.lang] += bool(own)
    total = sum(docs.values())
    got = {r.doc_id: r for r in queries.QUERIES["op11_language_id"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    sums = {lang: sum(c.values()) for lang, c in counts.items()}
    for r in rows:
        own = collections.Counter(fast_grams(r.text).tolist())
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not own:
            assert (g.lang_pred, g.score) == ("und", 0.0)
            continue
        logs = {lang: math.log(docs[lang] / total) + sum(n * (math.log(c[b] + 1) - math.log(sums[lang] + language_id.BUCKETS))
                                                         for b, n in own.items()) for lang, c in counts.items()}
        best = max(sorted(logs), key=logs.get)
        assert g.lang_pred == best
        assert g.score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), rel=1e-6)


def test_language_held_out_accuracy(spark):
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op11_language_id"](spark, "/root/testdata/sf0.01").join(truth, "doc_id").where("held_out and lang_pred <> 'und'")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.97


def test_language_odd_rows(spark, odd, empty):
    clash = odd.select("*", F.lit(1).alias("c0"), F.lit("x").alias("best"), F.lit(2).alias("top"), F.lit(3).alias("mass"))
    out = language_id.identify(clash, language_id.learn(odd))
    assert out.columns == [*clash.columns, "lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == len(ODD) and all(r.best == "x" and r.c0 == 1 and 0 <= r.score <= 1 for r in rows)
    pred = {r.doc_id: r.lang_pred for r in rows}
    assert [pred[i] for i in (1, 2, 3, 7)] == ["und", "und", "und", "fr"] and {pred[i] for i in (None, 4, 8)} <= {"en", "fr", "de"}
    assert language_id.identify(out, language_id.learn(odd)).columns == [*out.columns, "lang_pred_", "score_"]
    assert language_id.identify(empty, language_id.learn(odd)).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, language_id.learn(empty)).collect()} == {"und"}


def test_languages_in_blocks(spark, monkeypatch):
    """More languages than one matrix holds: the same answer in blocks."""
    rng = random.Random(1)
    words = {f"l{k:02}": ["".join(rng.choices("abcdefghij", k=5)) for _ in range(6)] for k in range(9)}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)), lang, "s", 0) for i, lang in enumerate(list(words) * 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    monkeypatch.setattr(language_id, "BLOCK", 2)
    split = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    assert whole == split and all(whole[i][0] == lang for i, _, lang, _, _ in rows)


# --------------------------------------------------------------- whitening

def brute_whitening(vectors, k=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    centred = x - s / n
    cov = centred.T @ centred / n
    e, p = np.linalg.eigh(cov)
    e, p = e[::-1][:k], p[:, ::-1][:, :k]
    return n, deviation, centred @ p, e, np.trace(cov)


def test_whitening_matches_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = vectors.unionByName(vectors.where("vec_id < 20"))
    rows = vectors.collect()
    n, deviation, z, e, trace = brute_whitening([r.embedding for r in rows])
    place = {r.vec_id: i for i, r in enumerate(rows)}
    out = queries_on(spark, vectors)
    assert len(out) == len(rows) * 32
    ours = np.zeros((len(rows), 32))
    for r in out:
        i, k = place[r.vec_id], r.component - 1
        assert r.n == n and int(r.deviation) == deviation[i]
        assert r.explained == pytest.approx(e[k] / trace, rel=1e-9) and r.identity_error < 1e-9
        ours[i, k] = r.whitened * math.sqrt(e[k])
    at = [place[r.vec_id] for r in rows]
    for k in range(32):  # either sign, the same for all rows
        assert min(np.abs(ours[at, k] - z[at, k]).max(), np.abs(ours[at, k] + z[at, k]).max()) < 1e-6
    white = ours[at] / np.sqrt(e)
    assert np.abs(np.cov(white.T, bias=True) - np.eye(32)).max() < 1e-9


def queries_on(spark, vectors, **options):
    return whitening.whiten(vectors, **options).collect()


@pytest.mark.parametrize("hot", [1, 1000])
def test_whitening_counts_copies(spark, monkeypatch, hot):
    """Copies weigh by their number, whichever way their rows are joined; with
    weights of one they weigh once."""
    monkeypatch.setattr(whitening, "HOT", hot)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 4)).round(3)
    rows = [(i, base[0 if i < 60 else i % 40].tolist()) for i in range(180)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    n, deviation, z, e, _ = brute_whitening([v for _, v in rows])
    out = queries_on(spark, vectors)
    assert len(out) == 180 * 4 and {r.n for r in out} == {n}
    for r in out:
        assert int(r.deviation) == deviation[r.vec_id]
        assert abs(r.whitened) == pytest.approx(abs(z[r.vec_id, r.component - 1]) / math.sqrt(e[r.component - 1]), abs=1e-8)
    once = queries_on(spark, vectors, weights="one")
    assert {r.n for r in once} == {40} and len(once) == 180 * 4


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, x string, w string, z string, i int"
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, None, "x", "w", "z", 0) for i, v in enumerate(
        [None, [1.0, None], [nan, 1.0], [inf, 1.0], [], [0.5, 1.0], [0.5, 1.0], [2.0, -1.0], [1e30, 3.0], [4.0, 0.25],
         [1.0, 2.0, 3.0], [1.0, 2.0, 3.0]])] + [(None, [0.5, 1.5], 1, None, None, None, None)]
    out = queries_on(spark, spark.createDataFrame(rows, schema))
    by = collections.defaultdict(list)
    for r in out:
        by[r.vec_id].append(r)
    assert set(by) == {5, 6, 7, 8, 9, 10, 11, None}
    assert all(len(v) == 2 for k, v in by.items() if k not in (10, 11))
    assert {r.n for r in by[5]} == {6} and {r.n for r in by[10]} == {2}
    # Equal vectors vary in no direction: nothing to divide by.
    assert len(by[10]) == 3 and all(r.whitened is None and r.identity_error is None and r.deviation == 0 for r in by[10])
    assert [r.whitened for r in by[5]] == [r.whitened for r in by[6]]
    assert queries_on(spark, spark.createDataFrame([], schema)) == []


# ------------------------------------------------------ importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute_features(text, longest=1):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)], len(w)


def brute_sample(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = {i: brute_features(t, longest) for i, (_, t) in enumerate(docs)}
    s, t = collections.Counter(), collections.Counter()
    for f, _ in own.values():
        s.update(map(bucket, f))
    for text in target:
        t.update(map(bucket, brute_features(text, longest)[0]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    rows = []
    for i, (doc_id, _) in enumerate(docs):
        f, n = own[i]
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_importance_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.QUERIES["op13_importance_resampling"](spark, sf)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6
    assert sorted(map(tuple, got.collect()), key=str) == brute_sample(docs, target)


@pytest.mark.parametrize("longest, piece", [(1, 1 << 20), (2, 1 << 20), (3, 200), (2, 7), (1, 1)])
def test_importance_runs_of_words(spark, monkeypatch, longest, piece):
    """Runs never cross documents, and pieces of a long text lose none."""
    monkeypatch.setattr(importance, "PIECE", piece)
    texts = [None, "", "a", "One, two; THREE four", "x" * 500, "été 中文 b c d", "tail " * 90 + "end", "...", "one two"]
    for at, (rows, bucket, part, n) in [(0, x) for x in importance.features(pa.array(texts, pa.string()), longest, 10_000)]:
        assert len(bucket) == len(part) and len(n) == len(rows)
    got = collections.defaultdict(list)
    words = collections.Counter()
    for rows, bucket, part, n in importance.features(pa.array(texts, pa.string()), longest, 10_000):
        for b, p in zip(bucket.tolist(), part.tolist()):
            got[rows[p]].append(b)
        for r, k in zip(rows.tolist(), n.tolist()):
            words[r] += k
    for i, text in enumerate(texts):
        f, n = brute_features(text, longest)
        assert sorted(got[i]) == sorted(zlib.crc32(x.encode()) % 10_000 for x in f)
        assert words[i] == n


def test_importance_odd_rows(spark, odd, empty):
    clash = odd.select("*", *[F.lit(1).alias(c) for c in ("key", "score", "weight", "rank", "n_words", "before", "place")])
    target = spark.createDataFrame([(1, "une phrase"), (2, None)], "item_id long, text string")
    cols = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    got = sorted(map(tuple, importance.resample(clash, target, percent=60, min_words=3, longest=2).select(*cols).collect()), key=str)
    want = brute_sample([(r[0], r[1]) for r in ODD], ["une phrase", None], longest=2, percent=60, least=3)
    # Repeated rows tie in everything: which copy is drawn first is all the same.
    assert got == want
    assert importance.resample(empty, target).count() == 0
    assert importance.resample(odd, target.limit(0)).count() == len(ODD)
    assert importance.resample(odd, target, min_words=10 ** 9).where("rank is not null").count() == 0


# ------------------------------------------------- near-duplicates in families

def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            n = len(sets[i] & sets[j])
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n) and root(i) != root(j):
                comp[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.randrange(10 ** 6)}"
    return out


@pytest.mark.parametrize("pivots", [0, 1, 3])
def test_families_far_from_their_hub(spark, monkeypatch, pivots):
    """Copies of variants that differ from the hub by a fifth, each with edits
    of its own, and strays that link with one of them only."""
    monkeypatch.setattr(near_dup, "PIVOTS", pivots)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    docs = [" ".join(edited(rng, base, k % 3)) for k in range(60)]
    for v in range(3):
        variant = base[:30 + 50 * v] + [f"v{v}x{i}" for i in range(12 + 4 * v)] + base[42 + 54 * v:]
        docs += [" ".join(edited(rng, variant, k % 4)) for k in range(50)]
        docs += [" ".join(edited(rng, variant, n)) for n in (4, 5, 6, 7, 8)]
    far = [f"f{i}" for i in range(100)] + base[100:]
    docs += [" ".join(edited(rng, far, k % 3)) for k in range(30)]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) > 3


def test_sketches_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(5)
    for shared, left, right in ((0, 0, 9), (40, 3, 0), (200, 60, 80), (5, 700, 900)):
        x, y, z = (rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (shared, left, right))
        a, b = near_dup._sketch(np.concatenate([x, y])), near_dup._sketch(np.concatenate([z, x]))
        bits = sum(int(v).bit_count() for v in a ^ b)
        assert bits <= left + right and (bits > 0) == (left + right > 0)


def test_members_that_share_a_difference_only_are_not_compared(spark, monkeypatch):
    """Copies with many edits, each from few words: any two share a difference
    from the base somewhere, none link with each other."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    docs = [" ".join(base)] + [" ".join(edited(rng, base, 1)) for _ in range(30)]
    for _ in range(90):
        words = list(base)
        for k in rng.sample(range(75), 6):
            words[2 * k] = f"c{rng.randrange(3)}"
        docs.append(" ".join(words))
    compared = []
    with_texts = near_dup._with_texts
    monkeypatch.setattr(near_dup, "_with_texts", lambda p, t: compared.append(p.count()) or with_texts(p, t))
    rows = list(enumerate(docs))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)
    assert sum(compared[1:]) < 3 * len(docs)


# ------------------------------------------------------------- mixing, lines

def test_lots_are_even_whatever_the_finish_times(spark, monkeypatch):
    """One source's finish times reach far; lots stay near the size meant, and
    the mix is that of one plain queue."""
    monkeypatch.setattr(source_mix, "SLOT_ROWS", 500)
    rows = [(i, "a b c", "big", "en", 0) for i in range(6000)] + [(10_000 + i, "x " * 50, f"s{i % 7}", "en", 0) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    lots = []
    kept = source_mix.common.stored

    def spy(df, name):
        out = kept(df, name)
        if name == "queue":
            lots.extend(r["count"] for r in out.groupBy("_lot").count().collect())
        return out
    monkeypatch.setattr(source_mix.common, "stored", spy)
    got = source_mix.mix(docs).collect()
    assert max(lots) <= 2 * 500 and sum(lots) == 2 * len(rows)
    budget = sum(r["size"] for r in got) * 3 // 2
    assert budget - 50 < sum(r.taken for r in got) <= budget


CLASH = ["_d", "_t", "_key", "_drop", "_lines", "_row", "_on", "key", "drop", "chunks", "n_lines", "at", "c", "first", "text_key"]


def test_line_dedup_with_clashing_columns(spark):
    passage = "\n".join(f"line {k} " + " ".join(f"w{k}x{i}" for i in range(30)) for k in range(4))
    rows = [(i, f"own {i}\n{passage}\nend {i}") for i in range(3)] + [(9, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])
    for f in (line_dedup.dedup_lines, line_dedup.remove_runs):
        out = f(docs)
        assert out.columns[:2 + len(CLASH)] == docs.columns
        got = out.collect()
        assert len(got) == 5 and all([r[c] for c in CLASH] == list(range(len(CLASH))) for r in got)
        if f is line_dedup.remove_runs:
            assert sum(r.text is not None and "w1x7" in r.text for r in got) == 1
    assert line_dedup.clean(docs).columns == docs.columns


# ------------------------------------------------------------ decontamination

def brute_contained(doc, item):
    d, i = (doc or "").lower().split(), (item or "").lower().split()
    if not i:
        return None
    width = min(len(i), 5)
    grams = lambda w: {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}
    a, b = grams(i), grams(d)
    return (len(a), len(a & b)) if 10 * len(a & b) >= 8 * len(a) else None


def decontamination_case():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 9, 14, 20, 33, 60, 84, 90, 130, 400)]
    items += ["capital of France is", None, "", items[9]]
    docs = [None, "", "capital of France is", "The Capital of france  IS Paris", items[0], items[1] + " x"]
    for item in items:
        if not item:
            continue
        w = item.split()
        for lost in (0, 1, max(1, len(w) // 30), len(w) // 20, len(w) // 6):
            own = list(w)
            for k in rng.sample(range(len(own)), min(lost, len(own))):
                own[k] = "other"
            docs.append(" ".join([*(word() for _ in range(rng.randrange(400))), *own, *(word() for _ in range(30))]))
    return docs, items


def test_items_of_every_size_inside_documents(spark):
    docs, items = decontamination_case()
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_item_shingles, r.n_common) for r in decontaminate.contaminated(d, i).collect()}
    want = {(a, b): found for a, doc in enumerate(docs) for b, item in enumerate(items) if (found := brute_contained(doc, item))}
    assert got == want
    assert {(2, 16), (3, 16)} <= set(got)


def test_size_classes_keep_look_ups_few(spark):
    """A short item costs look-ups in its own class, not in those of the long
    ones: per class, the share of shingles looked up falls with the size."""
    docs, _ = decontamination_case()
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    long_items = [(k, text(600)) for k in range(20)]
    d = spark.createDataFrame([(k, text(2000)) for k in range(50)], "doc_id long, text string")

    def looked_up(items):
        stored_items = decontaminate._items(spark.createDataFrame(items, "item_id long, text string"))
        classes = decontaminate._classes(stored_items)
        return {c.cls: n for c in classes for n in [decontaminate._probes(d, [c]).count()]}
    alone = looked_up(long_items)
    mixed = looked_up([*long_items, (100, "a short one"), (101, text(7)), (102, text(40))])
    assert all(mixed[c] == n for c, n in alone.items())
    total = 50 * 1996
    assert sum(alone.values()) < 0.1 * total and len(mixed) == len(alone) + 3


def test_classes_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, items = decontamination_case()
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.contaminated(d, i).collect()))
    for bound in (0, 10):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
        assert sorted(map(tuple, decontaminate.contaminated(d, i).collect())) == whole


def test_removal_and_odd_rows(spark):
    items = spark.createDataFrame([(1, "yes"), (None, "capital of France is"), (3, "a b c d e f g")], "item_id long, text string")
    rows = [(1, "Yes"), (2, "yes it is so"), (3, "the capital of france is near"), (4, "x a b c d e f g y"), (5, None), (6, ""),
            (None, "a b c d e f g"), (7, "clean text"), (7, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])
    out = decontaminate.remove(docs, items)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "5", "6", "7", "7"]
    assert decontaminate.remove(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []


# ------------------------------------------------------------ HTML extraction

@pytest.mark.parametrize("page, text", [
    ("<article><p>one</p><section id='user-comments'><p>first!</p></section></article>", "one"),
    ("<article><p>one</p><ol class='commentlist'><li>first!</li></ol></article>", "one"),
    ("<div class='main-menu'>menu</div><div>one</div>", "one"),
    ("<div class='postHeader siteNav'>menu</div><div>one</div>", "one"),
    ("<div class='page-header'>Site</div><div>one</div>", "one"),
    ("<div class='navigation-main'>menu</div><div>one</div>", "one"),
    ("<article><p>one</p><div class='cookie-notice-bar'>We use cookies</div></article>", "one"),
    ("<div hidden>no</div><div hidden=''>no</div><div>one</div>", "one"),
    ("<div style='color:red; display : none'>no</div><div style=visibility:hidden>no</div><div>one</div>", "one"),
    ("<p title=don't>one</p><p>two</p>", "one\n\ntwo"),
    ("<p title='it''s'>one</p><p data-x=\"a>b\">two</p><p title=a\"b>three</p>", "one\n\ntwo\n\nthree"),
    ("<article><p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>", "let x=2 be"),
    ("<div class='has-comments no-sidebar'>one</div><div class='article-content'>two</div>", "one\n\ntwo"),
    ("<div class='commentary'>one</div><div class='leadership header-image'>two</div>", "one\n\ntwo"),
    ("<p a=b =x / c>one</p><p>two", "one\n\ntwo"),
    ("<p>one</p><p title='open>two</p>", "one"),
])
def test_noise_by_name_and_stray_quotes(page, text):
    assert site_style_tree.main_text(f"<html><body>{page}</body></html>", frozenset()) == text


def brute_importance(rows):
    """Per (host, node): distinct pages, and 1 - mean over texts of
    log(pages with it) / log(pages)."""
    per = collections.defaultdict(lambda: collections.defaultdict(set))
    for host, page, node, text in rows:
        per[host, node][text].add(page)
    out = {}
    for key, texts in per.items():
        pages = len(set().union(*texts.values()))
        n = [len(p) for p in texts.values()]
        e = sum(k * math.log(k) for k in n) / sum(n) / math.log(pages) if pages > 1 else 0.0
        out[key] = (pages, 1 - e)
    return out


def test_importance_and_extraction_match_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        host = f"h{i % 3}.example"
        body = "".join(f"<div class=n{k}>{rng.choice(['always'] * 6 + [f'text {rng.randrange(9)}', f'own {i} {k}'])}</div>" for k in range(6))
        rows.append((i, f"http://{host}/{i}", f"<body>{body}<div class=t>Always here</div><div class=u>number {i}</div></body>"))
    rows += [(500, "http://h0.example/x", "x" * 300_000 + "<p>end"), (501, None, None), (502, "odd", ""), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", *[F.lit(k).alias(c) for k, c in enumerate(["row", "host", "page", "nodes", "texts", "main", "drop", "at", "b", "text"])])
    done = site_style_tree.parsed(pages)
    seen = site_style_tree.node_texts(done)
    want = brute_importance([tuple(r) for r in seen.select("host", "page", "node", "text").collect()])
    got = {(r.host, r.node): r for r in site_style_tree.importance(seen).collect()}
    assert set(got) == set(want)
    assert all((got[k].pages, got[k].importance) == (p, pytest.approx(e, abs=1e-9)) for k, (p, e) in want.items())
    # The same blocks go as by the plain function with its host's lists.
    low, sure = collections.defaultdict(set), collections.defaultdict(dict)
    for (host, node), (p, e) in want.items():
        if p >= site_style_tree.LEAST_PAGES and e < site_style_tree.LEAST_IMPORTANCE:
            low[host].add(node)
    counts = collections.Counter((host, node, text) for host, page, node, text in {tuple(r) for r in seen.select("host", "page", "node", "text").collect()})
    for (host, node, text), n in counts.items():
        p, e = want[host, node]
        if p >= site_style_tree.LEAST_PAGES and e >= site_style_tree.LEAST_IMPORTANCE and 1 - math.log(n) / math.log(p) < site_style_tree.LEAST_IMPORTANCE:
            sure[host][node, text] = e >= site_style_tree.SURE_IMPORTANCE
    out = site_style_tree.extract(pages)
    assert out.columns == ["page_id", "url", "text"]
    found = collections.Counter((r.page_id, r.text) for r in out.collect())
    host_of = lambda url: re.match(r"[^:]*://([^/]*)", url or "")
    plain = collections.Counter()
    for i, url, html in rows:
        host = m[1] if (m := host_of(url)) else ""
        plain[i, site_style_tree.main_text(html, frozenset(low[host]), sure[host])] += 1
    assert found == plain
    assert not any("Always here" in t for _, t in found) and found[500, "x" * 300_000 + "\n\nend"] == 1
    assert site_style_tree.extract(pages.limit(0)).collect() == []


def test_extraction_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = [(i, f"http://h.example/{i}", f"<body><div class=x>always the same</div><div class=y>text number {i}</div>") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(site_style_tree, "BROADCAST_ROWS", 0)
    assert {r.page_id: r.text for r in site_style_tree.extract(pages).collect()} == {i: f"text number {i}" for i in range(9)}


# ------------------------------------------------------------------- secrets

KEY = "aB3dE5gH7jK9mN1p"


@pytest.mark.parametrize("text, found", [
    (f"secret_{'b' * 140} = '{KEY}'", [KEY]),
    (f'password = aa_name; password = bb_name; aa_name = "{KEY}"; bb_name = "Zx81kkQ0pLm2vv"', [KEY, "Zx81kkQ0pLm2vv"]),
    (f'k = "{KEY}"\nk = "Zx81kkQ0pLm2vv"\npassword = k', [KEY, "Zx81kkQ0pLm2vv"]),
    (f'password = """{KEY}"""', [KEY]), (f"db_password = r'''\n{KEY}\n'''", [KEY]),
    (f"password: |\n  {KEY}\nuser: me", [KEY]), (f"db:\n  secret: >-\n    aB3dE5gH\n    7jK9mN1p\n  user: me", ["aB3dE5gH\n    7jK9mN1p"]),
    ('password = "aB3dE5" + "gH7jK9mN1p"', ['aB3dE5" + "gH7jK9mN1p']),
    (f'password = os.getenv("X", "{KEY}")', [KEY]), (f"token = Secret('{KEY}')", [KEY]),
    ('password = os.getenv("DB_PASSWORD")', []), ('password = os.getenv("DB_PASSWORD", "changeme")', []), ('token = read("secret_file.txt")', []),
    ('password = """Please enter your password here"""', []), ("password: |\nuser: me", []),
    ("a_secret = b_secret\nb_secret = a_secret", []),
])
def test_literals_of_every_form(text, found):
    spans = sorted(secret_scan.literal_spans(text))
    assert [text[a:b] for a, b, *_ in spans] == found


def test_secret_scan_odd_tables(spark, odd, empty):
    clash = odd.select("*", F.lit(1).alias("spans"), F.lit(2).alias("kind"))
    assert secret_scan.secrets(clash).count() == len(ODD) and secret_scan.secrets(empty).count() == 0
    long_text = "x = f(" * 20_000 + f'password = "{KEY}"' + " word" * 200_000
    assert [long_text[a:b] for a, b, *_ in secret_scan.literal_spans(long_text)] == [KEY]


# ----------------------------------------------------------------- URL filter

def brute_split(label, cost, unknown):
    """Cheapest split by trying all, the fewest pieces' order aside."""
    best = [0.0] + [math.inf] * len(label)
    for end in range(1, len(label) + 1):
        for start in range(end):
            piece = label[start:end]
            price = min(cost.get(piece, math.inf), unknown * (1 + len(piece) / 2))
            best[end] = min(best[end], best[start] + price)
    return best[-1]


def test_viterbi_matches_brute_force():
    rng = random.Random(4)
    cost = {"".join(rng.choices("abc", k=rng.randint(1, 4))): rng.uniform(1, 9) for _ in range(25)}
    for _ in range(200):
        label, unknown = "".join(rng.choices("abcd", k=rng.randint(1, 14))), rng.uniform(2, 12)
        priced = [(i, j, cost[label[i:j]]) for i in range(len(label)) for j in range(i + 1, len(label) + 1) if label[i:j] in cost]
        words = url_filter.split_words(label, priced, unknown)
        assert "".join(words) == label
        price = sum(min(cost.get(w, math.inf), unknown * (1 + len(w) / 2)) for w in words)
        assert price == pytest.approx(brute_split(label, cost, unknown))


def test_bayes_matches_brute_force(spark):
    rows = [("a", "casino", True), ("a", "zorb", True), ("b", "zorb", True), ("c", "calm", False), ("d", "calm", False), ("d", "zorb", False), ("d", "zorb", False)]
    words = spark.createDataFrame(rows, "_host string, word string, spam boolean")
    # A host with one blocked word is blocked as a whole.
    got = {r.word: r.odds for r in url_filter._odds(words).collect()}
    block = {h for h, _, s in rows if s}
    b, a = collections.Counter(), collections.Counter()
    for h, w in {(h, w) for h, w, _ in rows}:
        (b if h in block else a)[w] += 1
    for w in url_filter.SPAM:
        b[w] += url_filter.SEED_COUNT
    for w in url_filter.ORDINARY:
        a[w] += url_filter.SEED_COUNT
    vocabulary = set(a) | set(b)
    k = url_filter.SMOOTHING
    nb, na = sum(b.values()) + k * len(vocabulary), sum(a.values()) + k * len(vocabulary)
    for w in vocabulary:
        assert got[w] == pytest.approx(math.log((b[w] + k) / nb) - math.log((a[w] + k) / na))


def test_bayes_learns_words_of_hosts_held_out_from_the_seed_list(spark):
    """Hosts of two kinds; most unwanted ones have a listed word, those held out
    have none, and are told by what their paths share with the others."""
    rng = random.Random(9)
    bad, good = ([f"{x}{''.join(rng.choices('bdfglmnprst', k=2))}{y}{''.join(rng.choices('aeiou', k=2))}" for x in "qxz" for y in "vwk"] for _ in range(2))
    rows, held = [], {}
    for i in range(400):
        kind = i % 2
        path = "/".join(rng.choices(bad if kind else good, k=6))
        own = "".join(chr(97 + (7 * i // 26 ** k) % 26) for k in range(3))
        host = f"{'casino' if kind and i % 10 != 1 else 'plain'}{own}.example.com"
        rows.append((i, f"http://{host}/{path}"))
        if i % 10 in (0, 1):
            held[i] = "block" if kind else "allow"
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert not any(set(got[i].words) & set(url_filter.SPAM) for i in held)
    right = sum(got[i].verdict == v for i, v in held.items())
    assert right >= 0.95 * len(held)


def test_url_filter_odd_tables(spark):
    rows = [(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None), (3, "http://h.example.com/" + "ab/" * 50_000)]
    names = ["_host", "_path", "_h", "_p", "_words", "_row", "_rule", "_odds", "_found", "host", "words", "name"]
    pages = spark.createDataFrame(rows, "page_id long, url string").select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    out = url_filter.judge(pages).collect()
    assert len(out) == 4 and all([r[c] for c in names if c not in ("host", "words")] == [k for k, c in enumerate(names) if c not in ("host", "words")] for r in out)
    assert [r.verdict for r in out if r.page_id == 1] == ["block", "block"] and {r.host for r in out if r.page_id == 1} == {"a.net"}


# -------------------------------------------------------------------- ledger

def test_two_committers_of_one_batch(spark, odd, tmp_out):
    import threading
    one = ("v1", token_rollup.word_count(F.col("text")))
    won, start = [], threading.Barrier(2)

    class Late(token_rollup.Ledger):
        def has(self, batch):
            found = super().has(batch)
            start.wait(60)  # both have looked before either commits
            return found

    threads = [threading.Thread(target=lambda: won.append(Late(spark, tmp_out).commit("a", token_rollup.change(odd, None, one)))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False, True]
    totals = token_rollup.Ledger(spark, tmp_out).totals()
    assert totals.agg(F.sum("documents")).first()[0] == len(ODD)
    clash = odd.select("*", *[F.lit(1).alias(c) for c in ("tokenizer", "tokens", "sign", "old_source")])
    assert token_rollup.Ledger(spark, tmp_out).commit("b", token_rollup.change(clash, one, None))
    assert totals.sparkSession and token_rollup.Ledger(spark, tmp_out).totals().collect() == []


def test_good_documents_with_clashing_columns(spark, odd, empty):
    clash = odd.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])
    out = quality_rules.good(clash)
    assert out.columns == clash.columns and {r.doc_id for r in out.collect()} <= {7, None, 4, 1, 2, 3, 8}
    assert quality_rules.good(empty).count() == 0
    mixed = source_mix.mixture(clash.select("*", F.lit(1).alias("mix_row"), F.lit(2).alias("_lot"), F.lit(3).alias("size")))
    assert set(clash.columns) < set(mixed.columns) and mixed.count() > 0
    deduped = near_dup.deduplicate(clash.select("*", F.lit(1).alias("c0"), F.lit(2).alias("cls"), F.lit(3).alias("row")))
    assert set(clash.columns) < set(deduped.columns)
    assert suffix_tree.scores(clash).count() == len(ODD)


def test_em_matches_brute_force(spark):
    """The fitted model is that of plain expectation-maximisation."""
    rng = random.Random(3)
    sides = {"vote_a": -1, "vote_b": -1, "vote_c": 1}
    rows = collections.Counter()
    for _ in range(3000):
        ok = rng.random() < 0.8
        rows[tuple(side if rng.random() < (0.7 if (side > 0) == ok else 0.1) else 0 for side in sides.values())] += 1
    patterns = spark.createDataFrame([(*k, n) for k, n in rows.items()], "vote_a int, vote_b int, vote_c int, count long")
    got = quality_rules.fit(patterns, sides)
    q = quality_rules
    start = {"good": q.START_GOOD}
    for r, side in sides.items():
        start[f"good_{r}"] = (q.START_RIGHT if side > 0 else q.START_WRONG)[side]
        start[f"bad_{r}"] = (q.START_WRONG if side > 0 else q.START_RIGHT)[side]
    model = dict(start)

    def posterior(votes):
        odds = math.log(model["good"] / (1 - model["good"]))
        for r, v in zip(sides, votes):
            g, b = model[f"good_{r}"], model[f"bad_{r}"]
            odds += math.log(g / b) if v else math.log((1 - g) / (1 - b))
        return 1 / (1 + math.exp(-odds))
    for _ in range(q.ITERATIONS):
        soft = {v: (n * posterior(v), n * (1 - posterior(v))) for v, n in rows.items()}
        n = {"good": sum(g for g, _ in soft.values()), "bad": sum(b for _, b in soft.values())}
        new = {"good": (n["good"] + q.PRIOR_WEIGHT * q.START_GOOD) / (n["good"] + n["bad"] + q.PRIOR_WEIGHT)}
        for k, (r, side) in enumerate(sides.items()):
            rate = {}
            for i, kind in enumerate(("good", "bad")):
                hit = sum(w[i] for v, w in soft.items() if v[k])
                rate[kind] = (hit + q.PRIOR_WEIGHT * start[f"{kind}_{r}"]) / (n[kind] + q.PRIOR_WEIGHT)
            right, wrong = ("good", "bad") if side > 0 else ("bad", "good")
            rate[wrong] = min(rate[wrong], rate[right] / q.LEAST_RATIO)
            new |= {f"{kind}_{r}": v for kind, v in rate.items()}
        model = new
    assert got == pytest.approx(model)
    judged = patterns.select("*", q._posterior(got, sides).alias("p")).collect()
    assert all(r.p == pytest.approx(posterior((r.vote_a, r.vote_b, r.vote_c))) for r in judged)


# ------------------------------------------------------ 3 suffix tree, by hand

def _tree_by_hand(texts, held, p_min):
    """Scores of the same model, context by context, and its probabilities."""
    st = suffix_tree
    seqs = {i: re.findall(r"[^\x20\x09-\x0D]+", t.lower()) + [None] for i, t in texts.items()}
    train = [s for i, s in seqs.items() if not held[i]]
    uni = collections.Counter(w for s in train for w in s)
    total, size = sum(uni.values()), len(uni)
    least = max(p_min * total, st.MIN_COUNT)
    after = collections.defaultdict(collections.Counter)
    for s in train:
        for j in range(len(s)):
            for d in range(1, min(j, st.DEPTH) + 1):
                after[tuple(s[j - d:j])][s[j]] += 1
    symbols = {w for w, c in uni.items() if w is not None and c >= least}

    def root(w):
        return (uni[w] + 1) / (total + size + 1)

    other = 1 - sum(map(root, symbols)) - root(None)
    head = {(w,) for w in symbols if sum(after[w,].values()) >= least}
    for _ in range(st.DEPTH - 1):
        head |= {c + (w,) for c in head if len(c) < st.DEPTH for w, k in after[c].items() if k >= least and w in symbols}

    def smoothed(counts, n, q):
        p = {k: (c + st.SMOOTHING * q(k)) / (n + st.SMOOTHING) for k, c in counts.items()}
        left_p, left_q = max(1 - sum(p.values()), 1e-12), max(1 - sum(map(q, counts)), 1e-12)
        gain = sum(x * math.log(x / q(k)) for k, x in p.items()) + left_p * math.log(left_p / left_q)
        if not counts or n * gain < st.COST * len(counts) / 2 * math.log(max(n, 2)):
            return q
        return lambda k: p[k] if k in p else q(k) * left_p / left_q

    def in_head(ctx):
        """Probabilities of symbols, the end (None) and all others ('other words')."""
        if not ctx:
            return lambda k: other if k == "other words" else root(k)
        counts = collections.Counter()
        for w, c in after[ctx].items():
            counts[w if w is None or w in symbols else "other words"] += c
        n = sum(counts.values())
        return smoothed({k: c for k, c in counts.items() if c >= st.GAMMA * n or c >= least}, n, in_head(ctx[1:]))

    @functools.cache
    def model(ctx):
        if not ctx or ctx in head:
            p = in_head(ctx)
            return lambda w: p(w) if w is None or w in symbols else p("other words") * root(w) / other
        n = sum(after[ctx].values())
        return smoothed(after[ctx], n, model(ctx[1:])) if n >= st.MIN_COUNT else model(ctx[1:])

    score = {i: sum(math.log10(model(tuple(s[max(0, j - st.DEPTH):j]))(s[j])) for j in range(len(s))) for i, s in seqs.items()}
    return score, model, list(uni), [c for c in after if c not in head and model(c) is not model(c[1:])]


@pytest.mark.parametrize("p_min", [0.0, 0.02, 0.5])
def test_suffix_tree_by_hand(spark, monkeypatch, p_min):
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(30)]
    phrase = "one two three four five six seven"
    texts = {}
    for i in range(60):
        own = " ".join(words[int(k)] for k in np.minimum(random.zipf(1.3, 25), 30) - 1)
        texts[i] = own + (f" {phrase}" if i % 3 else "") + f" Only{i}\n{own[:20]}"
    texts[60], texts[61] = "", "w0 w0 w0 w0 w0 w0"
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    want, model, vocabulary, tail = _tree_by_hand(texts, held, p_min)
    monkeypatch.setattr(suffix_tree, "P_MIN", p_min)
    monkeypatch.setattr(suffix_tree, "PART_TOKENS", 200)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = suffix_tree.scores(docs).collect()
    assert len(got) == len(texts)
    assert all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-6) for r in got)
    assert bool(tail) == (p_min > 0)
    for ctx in [(), ("one",), ("one", "two", "three"), ("w0", "w1"), ("only4",)]:
        assert math.isclose(sum(map(model(ctx), vocabulary)) + model(ctx)("unknown"), 1, rel_tol=1e-9)


def test_suffix_tree_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "P_MIN", 0.1)
    docs = spark.createDataFrame([(i, f"alpha beta gamma delta {i % 4} epsilon") for i in range(40)], "doc_id long, text string")
    twice = docs.union(docs.where("doc_id = 8")).union(docs.where("doc_id = 8"))
    by_id = collections.defaultdict(set)
    for r in suffix_tree.scores(twice).collect():
        by_id[r.doc_id].add(round(r.score, 9))
    assert all(len(s) == 1 for s in by_id.values()) and len(by_id) == 40


def test_suffix_tree_grows(spark, monkeypatch):
    """Each text brings a phrase of its own, met four times: however small its
    share, the model learns it."""
    monkeypatch.setattr(suffix_tree, "P_MIN", 0.05)
    for n in (20, 200):
        docs = spark.createDataFrame([(i, " ".join([f"a{i} b{i} c{i} d{i}"] * 4)) for i in range(n)], "doc_id long, text string")
        rows = [r for r in suffix_tree.scores(docs).collect() if not r.held_out]
        assert all(r.score > r.base_score + 2 for r in rows)
