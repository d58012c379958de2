"""The training-data operators against SQL, brute force and odd rows."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from conftest import SF_SMALL
from tierwise.llm import (
    decontaminate, line_dedup, near_dup, quality_rules, queries, secret_scan, site_style_tree,
    source_mix, suffix_tree, token_rollup, url_filter,
)
from tools.compare_oracle import canon

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"the word{i % 37} of a sentence{i % 11}" for i in range(40))
#: Null, empty and blank texts, null ids, repeated rows, a long text, ties.
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (None, PROSE, "en", "s", 1),
       (None, PROSE, "en", "s", 1), (4, "one two", None, "t", 7), (4, "one two", None, "t", 7), (5, "One TWO", "en", None, 7),
       (6, PROSE + " tail", "en", "s", 1), (7, " ".join(f"w{i}" for i in range(30_000)), "en", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()], 12) == canon(cols, cur.fetchall(), 12)


# ------------------------------------------------------------ 1 quality rules

def test_quality_features_and_labels(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op1_quality_rules"](spark, SF_SMALL).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        w = WORD.findall(text)
        seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {k + j for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for j in range(8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    judged = [(labels[i], got[i].kept) for i in got if i in labels]
    assert sum(kept == bool(q) for q, kept in judged) >= 0.9 * len(judged)
    assert not [i for i in got if labels.get(i) == 1 and not got[i].kept and not got[i].base_failed]


def test_quality_odd_rows(spark, odd, empty):
    kept = quality_rules.good(odd).collect()
    assert {r.doc_id for r in kept} >= {None, 6} and len([r for r in kept if r.doc_id is None]) == 2
    assert not {r.doc_id for r in kept} & {1, 2, 3, 4, 5}
    assert quality_rules.good(empty).collect() == []
    clash = odd.withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    assert quality_rules.good(clash).columns == clash.columns


# ----------------------------------------------------------------- 2 the mix

def test_mix_meets_targets(spark, odd, empty):
    rows = queries.QUERIES["op2_source_mix"](spark, SF_SMALL).collect()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    assert math.isclose(sum({(r.source_size, r.target) for r in rows} and [t for _, t in {(r.source_size, r.target) for r in rows}]),
                        1.5 * sum(r["size"] for r in rows), rel_tol=1e-9)
    got = source_mix.mix(odd).collect()
    assert len(got) == len(ODD) and all(r.taken == 0 for r in got if r["size"] == 0)
    assert {r.source for r in got} == {None, "s", "t"}
    assert source_mix.mixture(empty).collect() == []
    assert source_mix.mixture(odd.withColumnRenamed("lang", "row")).columns[:5] == ["doc_id", "text", "row", "source", "n_chars"]


# ------------------------------------------------------------- 3 suffix tree

def test_suffix_tree(spark, texts, odd, empty):
    got = {r.doc_id: r for r in queries.QUERIES["op3_suffix_tree"](spark, SF_SMALL).collect()}
    words = {i: WORD.findall(t.translate(LOWER)) + [None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    rows = suffix_tree.scores(odd).collect()
    assert len(rows) == len(ODD) and all(r.score < 0 for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert suffix_tree.scores(empty).collect() == []


# -------------------------------------------------------------- 4 extraction

PAGE = ("<html><head><title>x</title><script>var a='<p>no</p>';</script></head><body><nav><a>menu</a></nav>"
        "<div class='ad'>buy</div><article><h1>Head</h1><p>one &amp; <b>two</b>\n three<br>four<p>five &lt;p&gt;"
        "<aside>side</aside><div class='comments'><p>first!</p></div></article><footer>foot</footer>")


def test_extraction(spark):
    assert site_style_tree.main_text(PAGE, frozenset()) == "Head\n\none & two three four\n\nfive <p>"
    assert site_style_tree.main_text(None, frozenset()) == "" and site_style_tree.main_text("a < b", frozenset()) == "a < b"
    # Without an article the style tree decides: the same line on each page goes.
    rows = [(i, f"http://h.example/{i}", f"<body><div class=x>always the same</div><div class=y>text number {i}</div>") for i in range(9)]
    rows += [(20, None, None), (21, "nothing", ""), (0, "http://h.example/0", rows[0][2])]
    got = site_style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    assert all(r.text == f"text number {r.page_id}" for r in got if r.page_id < 20)
    assert all(r.text == "" for r in got if r.page_id >= 20)


@pytest.mark.parametrize("page, text", [
    ("<div class='content-sidebar-wrap'><main><p>one</p></main></div>", "one"),
    ("<div class='has-sidebar'><article><p>one</p></article></div>", "one"),
    ("<div class='sidebar'><article><p>one</p></article></div>", "one"),
    ("<div class='sidebar'><article><p>card</p></article></div><article><p>one</p></article>", "one"),
    ("<form id='aspnetForm'><div>top</div><article><p>one</p></article></form>", "one"),
    ("<div>Site</div><form id='aspnetForm'><nav>menu</nav><div><p>the text of this page</p></div></form>", "Site\n\nthe text of this page"),
    ("<div>the text of this page</div><form><p>Your name</p></form>", "the text of this page"),
    ("<article><div class='post-header'><h1>Head</h1></div><div class='header'>By me</div><p>one</p></article>", "Head\n\nBy me\n\none"),
    ("<article><p>one</p><div class='related'><article><p>card</p></article></div></article>", "one"),
    ("<div class='comments'><article><p>first!</p></article></div><div>one</div>", "one"),
    ("<div class='advertisement'><main><p>buy</p></main></div><div class='site-footer'>foot</div><div id='cookie-banner'>ok</div>one", "one"),
])
def test_noise_around_articles(page, text):
    assert site_style_tree.main_text(f"<html><body>{page}</body></html>", frozenset()) == text


@pytest.mark.parametrize("tag", ["div", "article"])
def test_notice_among_content(spark, tag):
    # One path holds the notice of every page and paragraphs that differ.
    def page(i):
        return f"<body><{tag}><p>Always this notice</p>" + "".join(f"<p>text {i} {k}</p>" for k in range(9)) + f"</{tag}>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)] + [(50 + i, f"http://few.example/{i}", page(i)) for i in range(3)]
    # Near copies of one article: its paragraphs are no template.
    rows += [(80 + i, f"http://copies.example/{i}", "<article>" + "".join(f"<p>line {k}</p>" for k in range(9)) + f"<p>copy {i}</p>") for i in range(8)]
    got = {r.page_id: r.text for r in site_style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "\n\n".join(f"text {i} {k}" for k in range(9)) for i in range(12))
    assert all(got[50 + i].startswith("Always this notice") for i in range(3))
    assert all(got[80 + i] == "\n\n".join([*(f"line {k}" for k in range(9)), f"copy {i}"]) for i in range(8))


# ----------------------------------------------------------------- 5 secrets

def test_secrets(spark, texts, odd):
    got = {r.doc_id: r for r in queries.QUERIES["op5_secret_scan"](spark, SF_SMALL).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, text in texts.items():
        spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[i].spans.split(",")) or not joined
    assert secret_scan.secrets(odd).count() == len(ODD)


@pytest.mark.parametrize("text, found", [
    ('k = "aB3dE5gH7jK9mN1p"\ndb_password = k', ["aB3dE5gH7jK9mN1p"]),
    ('db_password = k\nk = "aB3dE5gH7jK9mN1p"', ["aB3dE5gH7jK9mN1p"]),
    ("postgres://me:s3cr3tPassw0rd@db/x", ["s3cr3tPassw0rd"]),
    ("run --auth-token Zx81kkQ0pLm2", ["Zx81kkQ0pLm2"]),
    ("<clientSecret>Zx81kkQ0pLm2</clientSecret>", ["Zx81kkQ0pLm2"]),
    ('password: "changeme"', []), ("key = value", []), ("The key: he said nothing at all.", []), ('title = "aB3dE5gH7jK9mN1p"', []),
])
def test_assignments(text, found):
    assert [text[a:b] for a, b, *_ in secret_scan.literal_spans(text)] == found


_CHAIN = [f"{x}{x}_name" for x in "abcdefghijklmnopqrstuvwxyz"]


@pytest.mark.parametrize("text, found", [
    ("DB_PWD=QwErTyUiOpAsDfGh\nx", ["QwErTyUiOpAsDfGh"]),
    ("db_password: QwErTyUiOpAsDfGh", ["QwErTyUiOpAsDfGh"]),
    ("export DB_PWD=horsebattery_Staple", ["horsebattery_Staple"]),
    ("db_password = k\nk = QwErTyUiOpAsDfGh", ["QwErTyUiOpAsDfGh"]),
    ('token = "My7kQ0pLm2Zx81kkS"', ["My7kQ0pLm2Zx81kkS"]), ('token = "your8Zx81kkQ0pLm2"', ["your8Zx81kkQ0pLm2"]),
    ('token = "exampleZx81kkQ0pLm2"', ["exampleZx81kkQ0pLm2"]),
    ('password = "aB3d E5gH 7jK9 mN1p"', ["aB3d E5gH 7jK9 mN1p"]),
    ("db_password = aa_name\n" + "\n".join(f"{a} = {b}" for a, b in zip(_CHAIN, _CHAIN[1:])) + f'\n{_CHAIN[-1]} = "aB3dE5gH7jK9mN1p"', ["aB3dE5gH7jK9mN1p"]),
    ("password = other_word\nother_word = password", []), ("password = userPasswordField;", []), ("token = config.auth_token", []),
    ("    password=db_password", []), ("DB_PWD=$OTHER_PASSWORD", []),
    ('password = "my_secret_password"', []), ('password: "your-password-here"', []), ('token = "YOUR_API_KEY"', []),
    ('password = "Please enter your password"', []),
])
def test_assignments_whole(text, found):
    assert [text[a:b] for a, b, *_ in secret_scan.literal_spans(text)] == found


# -------------------------------------------------------------------- 6 urls

def test_urls(spark):
    urls = ["https://A.Example.NET/en/1", "http://x.net/", "http://x.net", "http://sub.example.com/de/x?y", "http://w.org/fr/#a",
            None, "no scheme", "http://bestcasinobonus.com/pills", "https://citylibrary.example.com/history"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    r = {x.page_id: x for x in url_filter.judge(pages).collect()}
    assert [(r[i].rule, r[i].verdict) for i in range(5)] == [
        ("example.net/en/", "allow"), ("net/", "block"), (None, "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    assert (r[0].host, r[0].path, r[2].path) == ("a.example.net", "/en/1", "")
    assert all((r[i].host, r[i].path, r[i].rule, r[i].verdict) == ("", "", None, "allow") for i in (5, 6))
    assert r[7].verdict == "block" and {"casino", "bonus"} <= set(r[7].words)
    assert r[8].verdict == "allow" and {"city", "library"} <= set(r[8].words)
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_urls_whole(spark, monkeypatch):
    run = "freecasinobonusslotsjackpotpokerbettingonlinecasinowinnersviagrapills"
    urls = [f"http://a.example.org/{run}", "http://plain.example.com/" + "q" * 5000]
    # A word of 50 blocked hosts, one of a single one, and 250,000 other words, each once.
    urls += [f"http://casino{chr(97 + i // 26)}{chr(97 + i % 26)}.example.com/zorblax" for i in range(50)] + ["http://quiet.example.com/zorblax"]
    urls += ["http://casino.example.com/glimwort", "http://quiet.example.com/glimwort", "http://quiet.example.com/"]
    urls += [f"http://h{i}.example.com/" + "/".join("w" + "".join(chr(97 + (k // 26 ** j) % 26) for j in range(4)) + "x" for k in range(250 * i, 250 * i + 250))
             for i in range(1000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    r = {x.page_id: x for x in url_filter.judge(pages).where("page_id < 60").collect()}
    assert r[0].verdict == "block" and {"casino", "bonus", "jackpot", "viagra", "pills"} <= set(r[0].words)
    assert r[1].words[-1] == "q" * 5000
    assert "zorblax" in r[52].words and r[52].verdict == "block"
    assert r[54].words[-1] == "glimwort" and r[54].spam_odds != r[55].spam_odds
    few = pages.where("page_id < 60")
    want = sorted(map(str, url_filter.judge(few).collect()))
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", 0)
    assert sorted(map(str, url_filter.judge(few).collect())) == want


# ----------------------------------------------------------------- 7 rollups

def test_rollup_is_idempotent(spark, odd, tmp_out):
    from pyspark.sql import functions as F

    ledger = token_rollup.Ledger(spark, tmp_out)
    assert ledger.totals().collect() == []
    one = ("v1", token_rollup.word_count(F.col("text")))
    assert ledger.commit("a", token_rollup.change(odd, None, one))
    first = sorted(map(str, ledger.totals().collect()))
    assert not ledger.commit("a", token_rollup.change(odd, None, one))
    assert sorted(map(str, ledger.totals().collect())) == first
    assert ledger.commit("b", token_rollup.change(odd, one, ("v2", F.length("text").cast("long"))))
    assert {r.tokenizer for r in ledger.totals().collect()} == {"v1", "v2"} or {r.tokenizer for r in ledger.totals().collect()} == {"v2"}
    assert ledger.commit("c", token_rollup.change(odd.limit(0), one, None))


# ---------------------------------------------------------------- 8 near dup

def brute_components(rows):
    comp = {i: i for i in rows}
    sets = {i: shingles(t) for i, t in rows.items()}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(rows)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(n, edits, seed):
    """A text and copies of it with a few words replaced; and a chain."""
    import random
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for e in range(rng.randint(0, edits)):
            own[rng.randrange(150)] = f"e{k}x{e}"
        out.append(" ".join(own))
    for k in range(1, 12):  # each near the next only
        out.append(" ".join(f"c{i}" for i in range(4 * k, 4 * k + 150)))
    return out


def test_near_duplicates(spark, texts, odd, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op8_near_duplicates"](spark, SF_SMALL).collect()}
    assert got == brute_components(texts)
    rows = dict(enumerate(family(60, 8, 5)))
    made = near_dup.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in made.collect()} == brute_components(rows)
    kept = near_dup.deduplicate(odd)
    assert kept.columns == odd.columns
    # 6 and the two rows without an id are one group; 4, 4 and 5 another.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "7"]
    assert near_dup.deduplicate(empty).collect() == []


# ---------------------------------------------------------- 9 decontamination

def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (None, PROSE), (4, PROSE), (4, PROSE), (5, "not in any of these texts at all")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()}
    assert got == {(4, 1), (5, 1), (None, 4), (6, 4)}
    assert sorted(r.doc_id for r in decontaminate.remove(odd, items).collect()) == [1, 2, 3, 7]
    assert decontaminate.contaminated(empty, items).collect() == []
    assert decontaminate.remove(odd, items.limit(0)).count() == len(ODD)


def test_items_without_id_are_removed(spark, odd):
    items = spark.createDataFrame([(None, PROSE), (None, "one two"), (None, None), (5, "not in any of these texts at all")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.remove(odd, items).collect()) == [1, 2, 3, 7]
    assert decontaminate.contaminated(odd, items).collect() == []


# --------------------------------------------------------------- 10 line dedup

def test_line_dedup_odd_rows(spark, odd, empty):
    long = " ".join(f"p{i}" for i in range(60))
    extra = spark.createDataFrame([(10, f"a\n{long}\nb", "en", "s", 1), (11, f"c\n{long}\nd", "en", "s", 1), (12, long, "en", "s", 1)], SCHEMA)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(odd.union(extra)).collect()}
    assert got[10].text == f"a\n{long}\nb" and got[11].text == "c\nd" and got[12].text == ""
    assert got[1].text is None and got[3].text == " \n\t " and got[None].text == PROSE
    assert {r.doc_id for r in line_dedup.clean(odd.union(extra)).collect()} == {1, 2, 3, 4, 5, 6, 7, None, 10, 11}
    assert line_dedup.clean(empty).collect() == []
    clash = extra.withColumnRenamed("lang", "n_lines")
    assert line_dedup.clean(clash).columns == clash.columns


def brute_runs(rows):
    """Lines in a run of > 50 words (lines without words left out) that occurs
    earlier without overlap; by comparing all pairs of places."""
    lines = [(d, [(i, x, len(WORD.findall(x))) for i, x in enumerate(t.split("\n")) if WORD.search(x)]) for d, t in sorted(rows.items())]
    at = collections.defaultdict(list)
    for d, ls in lines:
        for k, (_, x, _) in enumerate(ls):
            at[x].append((d, k))
    of, drop = dict(lines), collections.defaultdict(set)
    for d, ls in lines:
        for k, (_, x, _) in enumerate(ls):
            for e, j in at[x]:
                if (e, j) >= (d, k):
                    break
                n = words = 0
                while k + n < len(ls) and j + n < len(of[e]) and ls[k + n][1] == of[e][j + n][1] and (e != d or j + n < k):
                    words += ls[k + n][2]
                    n += 1
                if words > 50:
                    drop[d].update(range(ls[k][0], ls[k + n - 1][0] + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop[d]) for d, t in rows.items()}


def test_repeated_runs(spark, texts, odd, empty):
    def line(name, n):
        return " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d = line("a", 30), line("b", 20), line("c", 10), line("d", 3)
    made = {1: f"x\n{a}\n{b}\n{c}\ny", 2: f"u\n{a}\n{b}\n{c}\nv", 3: f"{d}\n{a}\n\n{b}\n{c}\n{d}",  # foreign neighbours
            4: f"{a}\n{b}\nw", 5: f"{b}\n{a}", 6: f"{c}\n{d}\n{c}\n{d}", 7: "\n".join(["same again"] * 100), 8: line("e", 51), 9: line("e", 51)}
    got = {r.doc_id: r for r in line_dedup.remove_runs(spark.createDataFrame(list(made.items()), "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in got.items()} == brute_runs(made)
    assert (got[1].text, got[2].text, got[3].text, got[9].text, got[2].n_removed) == (made[1], "u\nv", f"{d}\n{d}", "", 3)
    assert got[4].text == made[4] and got[7].text == "\n".join(["same again"] * 26)  # 50 words are not more than 50
    small = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.remove_runs(small).collect()} == brute_runs(texts)
    assert {r.doc_id: r.text for r in line_dedup.clean(spark.createDataFrame(list(made.items()), "doc_id long, text string")).collect()}[2] == "u\nv"
    assert line_dedup.remove_runs(odd).count() == len(ODD) and line_dedup.remove_runs(empty).collect() == []


# ------------------------------------------------------------------- pipeline

def test_pipeline(spark, texts, odd, empty):
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns)
    left = {r.doc_id: r.text for r in rows}
    assert all(i == c for i, (_, c) in brute_components(left).items())
    for table in (odd, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMALL)
        docs.collect()
