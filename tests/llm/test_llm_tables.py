"""Operators over whole tables: top-k, URL filter, joins, mix, passages, pipeline."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from postsift.llm import curriculum, jaccard, suffixes, tables, topk, urls
from postsift.llm.components import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- exact top-k -------------------------------------------------------------------------


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "DATA_BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(400)]
    rows += [(i + 400, list(rows[i][1])) for i in range(40)] + [(20, [9.0] * 6)]  # ties, and a key told twice
    rows += [(500, None), (520, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (540, [float("nan")] * 6), (560, [float("inf")] * 6), (None, [1.0] * 6), (580, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    got = topk.exact_top_k(table, F.col("vec_id") % 20 == 0, k=7).collect()
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(64 * c) for c in v]
            usable[i] = min(x, usable.get(i, x))
    usable = {i: x + [0] * (6 - len(x)) for i, x in usable.items()}
    want = []
    for q in (i for i in usable if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(usable[q], x, strict=True)), i) for i, x in usable.items() if i != q)[:7]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_pivots_eliminate_where_vectors_cluster():
    """The share of candidates whose score is computed, of 20,000 in 100 clusters."""
    rng = np.random.default_rng(4)
    centres = np.floor(64 * rng.normal(size=(100, 64)))
    x = centres[rng.integers(0, 100, 20_000)] + rng.integers(-3, 4, (20_000, 64))
    shares = []
    for n in (16, 128):
        pivots = topk.choose_pivots(x[: topk.PIVOT_SAMPLE], n)
        best = topk.Best(np.arange(40), x[:40], pivots, 20)
        for begin in range(0, len(x), topk.DATA_BLOCK):
            part = x[begin : begin + topk.DATA_BLOCK]
            best.meet(np.arange(begin, begin + len(part)), part, topk.distances(part, pivots))
        shares.append(best.evaluated / best.offered)
        for i in range(40):
            scores = x @ x[i]
            scores[i] = -np.inf
            assert sorted(best.found[i][0]) == sorted(np.sort(scores)[-20:])
    assert shares[1] < 0.1 and shares[1] <= shares[0]


def test_number_of_pivots_does_not_change_the_result(spark):
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=5)]) for i in range(300)], "vec_id bigint, embedding array<double>")
    one, many = (sorted(map(tuple, topk.exact_top_k(table, F.col("vec_id") % 20 == 0, k=5, n_pivots=n).collect())) for n in (1, 200))
    assert one == many and len(one) == 75


@pytest.mark.parametrize("edge", [32767 / 64, 32768 / 64, -32768 / 64, -32769 / 64, 1e6])
def test_components_about_sixteen_bits(spark, edge):
    """Blocks travel in 16 bits as long as every component fits."""
    rows = [(20, [edge, 1.0]), (40, [-1.0, edge]), (41, [edge, edge]), (42, [0.5, -0.5])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    x = {i: [math.floor(64 * c) for c in v] for i, v in rows}
    dot = lambda a, b: sum(p * q for p, q in zip(x[a], x[b], strict=True))
    for q in (20, 40):
        want = sorted(((-dot(q, i), i) for i in x if i != q))
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want


@pytest.mark.parametrize("rows", [[], [(20, [1.0])], [(20, [0.0, 0.0]), (21, [0.0, 0.0])]])
def test_top_k_small(spark, rows):
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.collect()] == ([(20, 1, 21, 0)] if len(rows) > 1 else [])


# --- URL filter --------------------------------------------------------------------------


def test_url_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "mailto:x": ("", "", None), "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/"),
        "http://example.net/de/1": ("example.net", "/de/1", "net/"), "x://net": ("net", "", None), "https://net/": ("net", "/", "net/"),
        "https://internet/": ("internet", "/", None), "http://b.example.com/de/": ("b.example.com", "/de/", "example.com/de/"),
        "http://c.org/fr/?x": ("c.org", "/fr/", "org/fr/"), "http://c.org/fr": ("c.org", "/fr", None), "http://É.Z/a://b": ("É.z", "/a://b", None),
        "http://h?x/y": ("h", "", None), "a\nb://H\n/p": ("h\n", "/p", None),
    }
    rows = [(i, u) for i, u in enumerate(cases)] + [(0, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    verdicts = {h + p: v for h, p, v in urls.RULES}
    model = urls.train(spark)
    got = urls.url_filter(pages, model=model).collect()
    assert len(got) == len(rows)
    for row in got:
        host, path, rule = list(cases.values())[row.page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdicts[rule] if rule else row.verdict in ("allow", "block")
    assert urls.url_filter(pages.where("false"), model=model).collect() == []


def accuracy(rows):
    return sum((r.verdict == "block") == bool(r.page_id) for r in rows) / len(rows)


def test_url_model_on_held_out_rows(spark):
    """Half of the table, which names most kinds of hosts only once, by the other half."""
    half = urls.train(spark, urls.BLOCKED[::2], urls.ALLOWED[::2])
    rows = [(1, u) for u in urls.BLOCKED[1::2]] + [(0, u) for u in urls.ALLOWED[1::2]]
    got = urls.url_filter(spark.createDataFrame(rows, "page_id bigint, url string"), rules=(("none", "/", "block"),), model=half).collect()
    assert accuracy(got) > 0.65


def test_url_model_on_the_given_pages(spark, sf_dir):
    """Hosts of the given pages that carry a telling word, none of which was trained on."""
    pages = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet")
    bad = F.col("url").rlike("cheap-|casino-|spam-|adult-x|free-bets|ads-track")
    known = urls.BLOCKED + urls.ALLOWED
    labelled = pages.where(~F.col("url").isin(*known)).select(bad.cast("bigint").alias("page_id"), "url")
    assert accuracy(urls.url_filter(labelled, rules=(("none", "/", "block"),)).collect()) > 0.95


# --- joins -------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def join_by_hand(texts):
    sets = {i: shingles(t) for i, t in texts}
    links = {i: set() for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        out[i] = (min(seen), len(links[i]), min(j for j in sets if j == i or (sets[i] and sets[j] == sets[i])))
    return out


@pytest.mark.parametrize("options", [jaccard.JoinOptions(), jaccard.JoinOptions(small_bucket=3, levels=2, block_grams=300)])
def test_jaccard_join(spark, documents, options):
    rng = random.Random(9)
    texts = [None, "", " \n", "a b", "a  b", "b a", "one two three four five", "one two three four five six"]
    for _ in range(25):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(5, 90))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(500)}"
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    edge = [f"x{i}" for i in range(60)]
    texts += [" ".join(edge[:k] + [f"y{k}"] + edge[k + 1 :]) for k in range(0, 60)]  # a large group of near copies
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: (r.class_id, r.n_links, r.set_id) for r in jaccard.jaccard_join(documents(rows), options=options).collect()}
    assert got == join_by_hand(rows)


def test_blocks_are_bounded_by_sets_too(spark, documents):
    """Many different short texts in one group: few n-grams, many sets."""
    sized = spark.range(44_000).select(F.lit(1).alias("grp"), F.lit(9).alias("grams"))
    assert [tuple(r) for r in jaccard.block_counts(sized, jaccard.JoinOptions()).collect()] == [(1, 22)]
    assert [tuple(r) for r in jaccard.block_counts(sized.withColumn("grams", F.lit(100)), jaccard.JoinOptions()).collect()] == [(1, 22)]
    assert [tuple(r) for r in jaccard.block_counts(sized.withColumn("grams", F.lit(1000)), jaccard.JoinOptions()).collect()] == [(1, 110)]
    words = " ".join(f"w{i}" for i in range(12))
    rows = [(i, f"{words} v{i}") for i in range(300)]
    got = jaccard.jaccard_join(documents(rows), options=jaccard.JoinOptions(block_sets=40)).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 299, i) for i in range(300)]


class Blocks:
    """Stands for the dealt rows of `exact_links`; gives the function that compares them."""

    def repartition(self, *_):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, function, _):
        return function


@pytest.mark.parametrize("same", [True, False])
def test_comparing_blocks_takes_bounded_memory(same):
    """3,000 sets of two blocks, or 2,000 of one: no matrix over all pairs is held in wide numbers."""
    n, words = 2000 if same else 3000, " ".join(f"w{i}" for i in range(60))
    half = np.zeros(n, np.int64) if same else np.arange(n) // (n // 2)
    # Of each block the last 100 share nothing with the rest; number k + 1 stands for k + 1 copies.
    alone = np.arange(n) % 1000 >= 900 if same else np.arange(n) % 1500 >= 1400
    texts = [" ".join(f"u{i}x{k}" for k in range(30)) if a else f"{words} v{i}" for i, a in enumerate(alone)]
    columns = [np.ones(n), np.zeros(n), np.full(n, 0 if same else 1), half, np.arange(n), np.arange(n) + 1]
    batch = pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), pa.array(texts)], list("gijhrct"))
    compare = jaccard.exact_links(Blocks(), jaccard.JoinOptions())
    tracemalloc.start()
    try:
        got = pa.Table.from_batches(list(compare(iter([batch])))).to_pydict()
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    sums = np.array([((np.arange(n) + 1) * ~alone * (half == h)).sum() for h in (0, 1)])
    links = sums[0] - np.arange(n) - 1 if same else sums[1 - half]
    assert got["rep"] == list(range(n))
    assert got["other"] == np.where(alone, np.arange(n), 0).tolist()
    assert got["links"] == np.where(alone, 0, links).tolist()
    assert peak < 100, peak


def test_jaccard_join_odd_tables(spark, documents):
    assert jaccard.jaccard_join(documents([])).collect() == []
    text = " ".join(str(i) for i in range(30))
    got = jaccard.jaccard_join(documents([(1, text), (1, text), (2, text), (3, None), (None, text)])).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, 1), (1, 1, 2, 1), (2, 1, 2, 1), (3, 3, 0, 3)]


# --- mix ---------------------------------------------------------------------------------


def test_rows_with_one_id_are_documents_of_their_own(spark, documents):
    """Whatever the order of the rows, no link is lost and no row either."""
    w, a = " ".join(f"w{k}" for k in range(40)), " ".join(f"a{k}" for k in range(40))
    rows = [(1, w), (1, a), (2, w + " x"), (3, a + " y"), (4, "alone here"), (4, "alone here"), (None, w)]
    for order in (rows, rows[::-1]):
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.jaccard_join(documents(order)).collect())
        assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 1), (4, 4, 1)]


def test_passages_of_rows_with_one_id(spark, documents):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefghij") for _ in range(150))
    rows = [(1, "x" + passage), (1, "other " * 30), (2, passage + "y"), (2, passage + "z"), (3, "short")]
    for order in (rows, rows[::-1]):
        got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.repeated_passages(documents(order)).collect())
        assert [g[:2] for g in got] == sorted((i, len(t)) for i, t in rows)
        assert [g[2] for g in got if g[0] == 2] == [150, 150] and [g[2] for g in got if g[1] == 151 and g[0] == 1] == [0]


@pytest.mark.parametrize("contexts", [700, 4000])
def test_wide_passages_with_many_surroundings(spark, documents, contexts):
    """More surroundings of one fingerprint than an array holds at this width."""
    rng, width = random.Random(contexts), 700
    core = "".join(rng.choice("abcdefgh") for _ in range(suffixes.GRAM + 8))
    texts = []
    for k in range(contexts):
        r = random.Random(k % (contexts - 60))  # the last sixty repeat the first
        side = lambda n, r=r: "".join(r.choice("qrstuvwxyz") for _ in range(n))
        texts.append(side(680) + core + side(680))
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r.n_removed for r in suffixes.repeated_passages(documents(rows), width=width).collect()}
    assert all((n == len(texts[k])) == (k >= contexts - 60) and (n == 0) == (k < contexts - 60) for k, n in got.items())


def test_suffix_arrays_have_a_limit():
    with pytest.raises(ValueError, match="at most"):
        suffixes.suffix_order(np.zeros(suffixes.MOST_SYMBOLS + 1, np.int64), 100)


def test_mix_with_clashing_names(spark):
    """Every name used inside, as a column of the input."""
    names = "mix_key mix_range mix_digest mix_doc mix_begun mix_earlier mix_rank mix_payload words source_size target rank none c0 fills_at".split()
    rows = [(i, f"s{i % 3}" if i % 7 else None, *[f"{n}{i}" for n in names]) for i in [*range(60), 5]] + [(None, "s1", *[f"{n}None" for n in names])] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, " + ", ".join(f"{n} string" for n in names)).withColumn("a.b", F.lit(1))
    mixed = curriculum.curriculum_mix(frame, size=F.lit(7))
    assert mixed.columns[: len(names) + 3] == ["doc_id", "source", *names, "a.b"]
    got = mixed.collect()
    assert len(got) == len(rows)
    assert all(r["mix_key"] == f"mix_key{r['doc_id']}" for r in got)
    plain = curriculum.curriculum_mix(frame.select("doc_id", "source"), size=F.lit(7)).collect()
    assert sorted((str(r.doc_id), str(r.source), r.mix_taken) for r in got if r.doc_id is not None) == sorted((str(r.doc_id), str(r.source), r.mix_taken) for r in plain if r.doc_id is not None)


def targets_by_hand(sizes):
    """Share by weight, cap, share the excess anew, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_curriculum_mix(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "Z", "é", None, "tiny"])) for i in range(500)]
    rows += [(900, None, "only null"), (901, "", ""), (902, "x " * 5000, "tiny"), (3, "again", "b"), (None, "no id", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("mix_size", F.lit("clash"))
    got = curriculum.curriculum_mix(docs, size=curriculum.word_count(F.col("text"))).collect()
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets_by_hand(sizes)
    for r in got:
        assert r.mix_source_size == sizes[r.source] and r.mix_target == pytest.approx(want[r.source])
        assert r.mix_size == len(WORD.findall(r.text or "")) and 0 <= r.mix_taken <= 2 * r.mix_size
        assert r.mix_taken == sum(t.words for t in r.mix_takes) and all(0 <= t.position <= 1 for t in r.mix_takes)
        taken[r.source] = taken.get(r.source, 0) + r.mix_taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    places = [r.mix_position for r in got if r.mix_position is not None]
    assert places == sorted(places)
    again = curriculum.curriculum_mix(docs.repartition(7), size=curriculum.word_count(F.col("text"))).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_schedule_is_inverted(spark):
    """The words due by a time are the integral of the source's weight up to it."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit(10).alias("n"))
    rows = curriculum.curriculum_mix(docs, size=F.col("n")).select("source", "mix_target", F.explode("mix_takes").alias("t")).collect()
    for source, (a, b) in zip(("s0", "s1", "s2"), curriculum.SCHEDULES, strict=True):
        own = [(r.t.position, r.t.words, r.mix_target) for r in rows if r.source == source]
        for t in (0.25, 0.5, 0.75):
            due = (a * t + (b - a) * t * t / 2) / ((a + b) / 2)
            assert sum(w for p, w, _ in own if p <= t) / own[0][2] == pytest.approx(due, abs=0.01)


def test_first_words(spark):
    row = spark.createDataFrame([(" a\tb  c d ", 3)], "t string, n bigint").select(curriculum.first_words(F.col("t"), F.col("n"))).first()
    assert row[0] == " a\tb  c"
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert curriculum.curriculum_mix(empty, size=curriculum.word_count(F.col("text"))).collect() == []


# --- passages ----------------------------------------------------------------------------


@pytest.mark.parametrize(("width", "n", "letters"), [(9, 200, 2), (100, 3000, 2), (30, 1500, 1), (100, 4000, 20), (5, 50, 3)])
def test_suffix_order(width, n, letters):
    rng = np.random.default_rng(3)
    buf = rng.integers(0, letters, n).astype(np.uint8)
    buf = np.concatenate([buf, buf[20 : n // 2], buf])
    order = suffixes.suffix_order(buf.astype(np.int64) + 1, width)
    assert sorted(order) == list(range(len(buf)))
    prefixes = [buf[p : p + width].tobytes() for p in order if p + width <= len(buf)]
    assert prefixes == sorted(prefixes)
    starts = np.arange(len(buf) - width + 1)
    seen, want = set(), []
    for p in starts:
        want.append(buf[p : p + width].tobytes() in seen)
        seen.add(buf[p : p + width].tobytes())
    assert suffixes.repeats(buf, starts, width).tolist() == want


def passages_by_hand(rows, width=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            if data[p : p + width] in seen:
                gone[p : p + width] = True
            seen.add(data[p : p + width])
        out[i] = (len(data), int(gone.sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("most", [4096, 2])
def test_repeated_passages(spark, documents, monkeypatch, most):
    """With few surroundings allowed per task, common fingerprints go string by string."""
    monkeypatch.setattr(suffixes, "MOST_CONTEXTS", most)
    rng = random.Random(6)
    words = ["river", "mill", "é", "old", "the", "of", "漢字", "bell", "pond", "a"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(40) for _ in range(4)]
    texts = ["", "short", "a" * 500, "a" * 99, "ab" * 300, passages[0], passages[0], passages[0] + passages[0]]
    for _ in range(60):
        texts.append(say(rng.randrange(0, 60)) + rng.choice(passages)[rng.randrange(0, 30) :] + say(rng.randrange(0, 60)))
    texts += [texts[20], texts[20][:-1] + "Ω", "x" + texts[20]]
    rows = list(enumerate(texts))
    got = suffixes.repeated_passages(documents([*rows, (3, texts[3]), (None, "no id"), (500, None)]))
    want = passages_by_hand(rows) | {500: (0, 0, hashlib.sha256(b"").hexdigest())}
    found = got.collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in found} == want
    for r in found:
        assert r.n_spans == len(r.spans) and r.n_removed == sum(s.end - s.start for s in r.spans)
    assert sorted(r.doc_id for r in found) == sorted([*want, 3])  # the row that repeats an id has one of its own


def test_wide_passages(spark, documents):
    """Offsets of 256 and more: two k-grams of a string, far apart."""
    rng = random.Random(8)
    say = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passages = [say(1500) for _ in range(3)]
    rows = [(i, say(rng.randrange(400)) + rng.choice(passages)[rng.randrange(300) :] + say(rng.randrange(400))) for i in range(20)]
    found = suffixes.repeated_passages(documents(rows), width=700).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in found} == passages_by_hand(rows, 700)
    for width in (24, 65_560):
        with pytest.raises(ValueError, match="width"):
            suffixes.repeated_passages(documents(rows), width=width)


@pytest.mark.parametrize("most", [2, 4096])
def test_passages_that_a_third_of_all_documents_share(spark, documents, monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_CONTEXTS", most)
    monkeypatch.setattr(suffixes, "STRING_SHARES", 3)
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = say(180)
    rows = [(i, say(130) + (shared if i % 3 == 0 else "") + say(130)) for i in range(120)]
    told = []
    find = suffixes.hot_fingerprints
    monkeypatch.setattr(suffixes, "hot_fingerprints", lambda *of: told.append(find(*of)) or told[-1])
    frame = documents(rows).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in suffixes.repeated_passages(frame).collect()}
    assert got == passages_by_hand(rows) and len(told[0])
    monkeypatch.setattr(suffixes, "hot_fingerprints", lambda *of: np.empty(0, np.int64))
    plain = {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in suffixes.repeated_passages(frame).collect()}
    assert plain == got


def test_no_passages(spark, documents):
    assert suffixes.repeated_passages(documents([])).collect() == []


# --- queries and pipeline ----------------------------------------------------------------


def test_queries_against_sql(spark, sf_dir):
    from compare import duck, rows_of
    from postsift.llm.queries import QUERIES, SQL

    con = duck(sf_dir)
    for name, sql in SQL.items():
        frame = QUERIES[name](spark, sf_dir)
        cursor = con.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(frame.columns)
        assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, cursor.fetchall()), name


def test_query_names():
    import __spark_entry__ as entry

    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in names


def test_passages_query(spark, sf_dir):
    from postsift.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in QUERIES["op10_suffix_dedup"](spark, sf_dir).collect()}
    assert got == passages_by_hand(rows)


def test_pipeline_stages(spark, sf_dir, tmp_path):
    """Each stage against brute force on the input it got."""
    import corpus_pipeline
    from test_llm_text import check_pieces, repetition_by_hand

    docs, rows = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    extra = [(None, "no id but words enough for every rule to let this row pass", "en", None, None), (10_000, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if k < 4:
            assert sorted(docs.columns) == sorted(corpus_pipeline.COLUMNS)
        if k == 0:
            failed = {i for i, t, _ in before if (m := repetition_by_hand(t or ""))[0] < 10 or 100 * m[4] > 20 * m[0]}
            assert {r.doc_id for r in rows} == {i for i, _, _ in before} - failed
        elif k == 1:
            classes = join_by_hand([(i, t) for i, t, _ in before if i is not None])
            assert sorted(-1 if r.doc_id is None else r.doc_id for r in rows) == sorted([i for i in classes if classes[i][0] == i] + [-1])
        elif k == 2:
            want = passages_by_hand([(i, t) for i, t, _ in before if i is not None])
            gone = {i for i, w in want.items() if w[0] == w[1] and w[0]}
            assert {r.doc_id for r in rows} == {i for i, _, _ in before} - gone
            assert all(r.text == t for i, t, _ in before for r in rows if r.doc_id == i and i is not None and not want[i][1])
        elif k == 3:
            sizes, taken = {}, {}
            for _, text, source in before:
                sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
            for r in rows:
                taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
                assert r.doc_id is None or r.n_chars == len(r.text)
            for source, target in targets_by_hand(sizes).items():
                assert abs(taken.get(source, 0) - target) <= 1
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in rows) == sum(1 + len(tokenizer.encode(t, add_special_tokens=False).ids) for _, t, _ in before)
    once = {i for i, _, _ in before if sum(j == i for j, _, _ in before) == 1 and i is not None}
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t, _ in before if i in once}
    for i in once:
        own = sorted((r.start, r.length, bytes(r.ids)) for r in rows if r.doc_id == i)
        assert b"".join(p for _, _, p in own) == np.array(ids[i], "<u4").tobytes()
    assert check_pieces is not None


def test_stored_tables_are_discarded_and_no_others(spark, tmp_path):
    given = str(tmp_path / "stored-given")
    spark.range(5).write.parquet(given)
    frame, kept = tables.stored(spark.range(3)), tables.stored(spark.range(2))
    folder = frame.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
    tables.discard(frame)
    tables.discard(spark.read.parquet(given))
    tables.discard(tables.stored(spark.range(0)))
    assert not os.path.exists(folder)
    assert (kept.count(), spark.read.parquet(given).count()) == (2, 5)
