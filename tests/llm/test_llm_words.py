"""Pieces, prefix tries and spelling variants against the library and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from postsift.llm import piecewise, prefixtrie, spellings

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- 11: pieces ----------------------------------------------------------------------------

ODD = (
    ["", " ", "  ", "▁", "▁▁ a", "a" * 5000, " " * 3000, "ab" * 2000, "中文" * 500, "́" * 40, "<s>", "</s> <0x0A>", "�", "🙂" * 50]
    + ["x\x00y", "the  end\n\n\tof it ", "nobreak space", "ﬁ ligature", "​zero‍", "ünï côdé", "A" * 33 + " " + "b" * 32]
)


def odd_texts():
    rng = random.Random(5)
    letters = "ab ▁\n\t\0éß中文日本語字🙂​﻿the ing tion  <0x41></s><unk>xyzXYZ.,!'019"
    return [*ODD, *("".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(400))]


def test_pieces_are_those_of_the_library(spark, documents):
    library = SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts()
    rows = piecewise.with_pieces(documents(list(enumerate([None, *texts]))), path=MODEL, check="texts").collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        text = "" if row.doc_id == 0 else texts[row.doc_id - 1]
        want = library.encode(text, add_eos=True)
        assert row.ids == want, text[:40]
        assert row.decoded == library.decode(want)
        assert row.library_agrees


def test_every_segment_is_checked_and_repeats_agree(spark, documents):
    texts = ODD * 2
    rows = piecewise.with_pieces(documents(list(enumerate(texts))), path=MODEL).collect()
    assert all(r.library_agrees for r in rows)
    by_text = defaultdict(set)
    for r in rows:
        by_text[texts[r.doc_id]].add(tuple(r.ids))
    assert all(len(v) == 1 for v in by_text.values())
    unchecked = piecewise.with_pieces(documents([(1, "abc")]), path=MODEL, check=None).collect()
    assert unchecked[0].library_agrees is None
    assert piecewise.with_pieces(documents([]), path=MODEL).collect() == []
    with pytest.raises(ValueError):
        piecewise.with_pieces(documents([]), path=MODEL, check="no")


def test_a_difference_to_the_library_is_told():
    encoder = piecewise.Encoder(piecewise.vocabulary(MODEL))
    rank = encoder.vocabulary.pair_rank
    wrong = np.where(rank == rank.min(), rank.max(), rank).astype(np.int32)
    encoder.vocabulary.pair_rank = wrong
    try:
        _, _, agrees = encoder.encode(["at the end", "zzz"])
        assert agrees.tolist() == [encoder.vocabulary.library.encode("at the end") == piecewise.Encoder(encoder.vocabulary, False).encode(["at the end"])[0][:-1].tolist(), True]
    finally:
        encoder.vocabulary.pair_rank = rank


def test_agenda_in_step_and_by_heap_agree():
    v = piecewise.vocabulary(MODEL)
    rng = random.Random(3)
    segments = ["▁" + "".join(rng.choice("thein▁gaor日éx") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    ids, bounds = v.in_step(segments)
    for k, s in enumerate(segments):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == v.by_heap(s).tolist()


def test_a_megabyte_without_a_cut():
    v = piecewise.vocabulary(MODEL)
    ids, bounds, agrees = piecewise.Encoder(v).encode(["e" * 1_000_000, "short"])
    assert agrees.all()
    assert ids[: bounds[1]].tolist() == v.library.encode("e" * 1_000_000, add_eos=True)


def test_decoding_any_ids():
    v = piecewise.vocabulary(MODEL)
    rng = random.Random(9)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), 2]) for _ in range(rng.randint(0, 20))]
        assert piecewise.decode(np.array(ids, np.int32), np.array([0, len(ids)]), v) == [v.library.decode(ids)], ids


# --- 12: prefix trie -----------------------------------------------------------------------


def brute_trie(rows):
    """Every node by listing all prefixes of all rebuilt conversations."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(original):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(original.get(base, [])[:h] + original[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p], digest(p)) for p, m in members.items()
    )


def trie_rows(spark, rows):
    schema = "conv_id bigint, turn int, role string, text string, node string, shard string, depth string, n_convs string"
    frame = spark.createDataFrame([(*r, "n", "s", "d", "c") for r in rows], schema)
    found = prefixtrie.prefix_trie(frame).collect()
    return sorted(
        (r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_that_of_all_prefixes(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(-250, 5000), 150) + [0, 100, 1000, 3000]
    rows = []
    for c in set(ids):
        for k in range(rng.choice([1, 2, 3, 9])):
            rows.append((c, rng.choice([k, k, k, None, 0]), rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "é🙂", "", None])))
    rows += [(None, 1, "user", "nobody"), *rows[:5]]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_hot_conversation_over_many_shards(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(0, 6000, 7) for k in range(3)]
    rows += [(c, k, "user", f"turn {k}" if k < 2 else f"own {c}") for c in range(3, 6000, 70) for k in range(4)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_turnless_and_single_and_empty(spark):
    # 4321 takes its first turns from 4300, which is absent, and keeps none of its own.
    single = next(c for c in range(4301, 4400) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(single, 0, "user", "gone")]
    assert trie_rows(spark, rows) == brute_trie(rows)
    assert len(trie_rows(spark, rows)) == 1
    assert trie_rows(spark, []) == []
    long = [(7, k, "user", "x" * (k % 3)) for k in range(40)] + [(8, 0, None, "y" * 200_000)]
    assert trie_rows(spark, long) == brute_trie(long)


def test_a_long_conversation(spark):
    found = trie_rows(spark, [(c, k, "user", str(k)) for c in (0, 5000) for k in range(3000)])
    assert [(r[0], r[1], r[3], r[5]) for r in found] == [(0, d, 2, 1) for d in range(3001)]
    assert found[0][6] == sum(len(str(k)) for k in range(3000))


# --- 13: spelling variants -----------------------------------------------------------------


def brute_spellings(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def spelling_rows(frame):
    found = spellings.spelling_variants(frame).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in found)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    letters = "abcÀéÿ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(12)]

    def slip(word):
        at, how = rng.randrange(len(word) + 1), rng.randrange(4)
        if how == 0:
            return word[:at] + rng.choice(letters) + word[at:]
        if how == 1:
            return word[:at] + word[at + 1 :]
        if how == 2:
            return word[:at] + rng.choice(letters) + word[at + 1 :]
        return word

    rows = []
    for doc in range(60):
        words = [rng.choice(stems[: rng.randint(1, 12)]) for _ in range(60)]
        rows.append((doc, rng.choice([" ", "-", "\n", "3"]).join(slip(w) if rng.random() < 0.5 else w.upper() for w in words)))
    rows += [(None, rows[0][1]), (5, None), (6, ""), rows[1]]
    schema = "doc_id bigint, text string, word string, n string, form string, root string"
    frame = spark.createDataFrame([(*r, "w", "n", "f", "r") for r in rows], schema)
    want = brute_spellings(rows)
    assert spelling_rows(frame) == want
    assert any(w[1] for w in want)


def test_chains_ties_and_long_texts(spark, documents):
    # aaaaa -> aaaab -> aaabb and so on: every form has twice the occurrences.
    chain = ["vwxyz", "vwxya", "vwxba", "vwcba", "vdcba", "edcba"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k))
    ties = " ".join(["green"] * 3 + ["greens"] * 6 + ["grean"] * 6)
    rows = [(1, text), (2, ties), (3, "lengthy " * 200_000)]
    frame = documents(rows)
    assert spelling_rows(frame) == brute_spellings(rows)
    assert spelling_rows(documents([])) == []
    with pytest.raises(ValueError):
        spellings.spelling_variants(frame, times=1)
