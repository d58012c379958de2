"""Near-duplicates move only the texts they compare, small tables take few tasks,
the style tree stores its counts once."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from test_round3_ops import brute_components, edited
from tierwise.llm import common, near_dup, site_style_tree


def test_rounds_read_the_texts_of_open_pairs_only(spark, monkeypatch):
    """Copies of a base and of variants far from it, with edits of their own:
    the rounds after the first read no text that they do not compare."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    docs = [" ".join(edited(rng, base, k % 3)) for k in range(40)]
    for v in range(2):
        variant = base[:30 + 50 * v] + [f"v{v}x{i}" for i in range(14)] + base[44 + 50 * v:]
        docs += [" ".join(edited(rng, variant, k % 4)) for k in range(40)]
    docs += [" ".join([f"t{k}_{i}" for i in range(40)] + [f"end{c}"]) for k in range(30) for c in range(2)]
    rows = list(enumerate(docs))
    read = []
    with_texts = near_dup._with_texts

    def spy(pairs, texts):
        wanted = {r.row for r in pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct().collect()}
        read.append((wanted, {r.row for r in texts.select("row").collect()}))
        return with_texts(pairs, texts)
    monkeypatch.setattr(near_dup, "_with_texts", spy)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)
    assert len(read) > 1
    assert [texts - wanted for wanted, texts in read[1:]] == [set()] * (len(read) - 1)


def test_small_tables_take_few_tasks(spark, monkeypatch):
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    paths = []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        monkeypatch.setattr(common, "TASK_ROWS", 100)
        assert [common.few(spark.range(0, 9, 1, 60), n).rdd.getNumPartitions() for n in (0, 100, 101, 3999, 4001)] == [1, 1, 2, 60, 60]
        edges = [(k, k - k % 10) for k in range(150)]
        with common.recording(paths):
            got = near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {(r.node, r.comp) for r in got} == {(k, k - k % 10) for k in range(150)}
        assert all(len(pq.ParquetDataset(p.removeprefix("file:")).files) <= 2 for p in paths) and paths
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pages_are_counted_in_one_stored_table(spark, monkeypatch):
    """Beside the parsed pages and the answer, the tree stores its counts, its
    template and what goes; copies of a page and repeats on it count once."""
    made = []
    stored = common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: made.append(name) or stored(df, name))
    page = "<body><div class=x>menu</div><div class=x>menu</div><div class=y>text number {}</div>"
    rows = [(i, f"http://h.example/{i}", page.format(i // 2)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in site_style_tree.extract(pages).collect()} == {i: f"text number {i // 2}" for i in range(12)}
    assert made == ["parsed-pages", "text-counts", "template", "removals"]
    counts = site_style_tree.text_counts(site_style_tree.node_texts(site_style_tree.parsed(pages)))
    assert sorted((r.text is None, r.n) for r in counts.collect()) == [(False, 1)] * 6 + [(False, 6)] + [(True, 6)] * 2
