"""Operators that read texts one by one: main text, licenses, repetition, token counts, packing."""

from __future__ import annotations

import collections
import random
import re
import textwrap
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from postsift.llm import licenses, maintext, packing, repetition, transducer
from postsift.llm.labelled_pages import LABELLED, PAGES, made_page, unnamed
from postsift.llm.texthash import text_slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def odd_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "aAbtsrevlmd'' \t\n0९é.,<| 漢🙂\u3000\xa0"
    fixed = [
        "", "a", "  a", "a  ", "\n\n's x", "don't 's we're they'll I'd''s 'sam x'", "tab\t\tx \n y", "é'ê’s",
        "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "१२३ x²", "🙂🙂 x🙂", "a" * 3000,
        "ab" * 2000 + " " * 1500 + "x", "'" * 700 + "s", "\x00\x01 \x1c\x1d", "   's", "\r\n\r\nfoo", "' s",
    ]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))) for _ in range(n)]


# --- main text ---------------------------------------------------------------------------


def accuracy(tree, pages) -> float:
    x, y = maintext.labelled_blocks(pages)
    return float((tree.predict(x) == y).mean())


def test_tree_on_held_out_pages():
    """Every hand-made page of the labelled table, by a tree trained without it and its unnamed form."""
    right = total = 0
    for k, held_out in enumerate(PAGES):
        tree = maintext.Tree()
        tree.grow(*maintext.labelled_blocks([p for j, p in enumerate(LABELLED) if j not in (k, k + len(PAGES))]), 12, 2)
        x, y = maintext.labelled_blocks([held_out])
        right, total = right + int((tree.predict(x) == y).sum()), total + len(y)
    assert right / total > 0.85


def test_neighbours_decide_where_names_are_missing():
    """Held-out pages: with telling names, and without any."""
    tree = maintext.trained()
    named = [made_page(seed) for seed in range(1000, 1300) if seed % 3 < 2]
    bare = [made_page(seed) for seed in range(1000, 1300) if seed % 3 == 2]
    assert accuracy(tree, named) > 0.99
    assert accuracy(tree, bare) > 0.9
    assert not any(tag in html for html, _ in bare for tag in ("class=", "id=", "role=", "<nav", "<article", "<footer"))


def test_no_flag_alone_is_the_tree():
    """No name, and no single split, gives the verdicts of the tree; its first splits are of what is around."""
    tree = maintext.trained()
    x, _ = maintext.labelled_blocks(LABELLED)
    verdicts = tree.predict(x)
    for k, name in enumerate(maintext.FEATURES):
        for cut in np.unique(x[:, k]):
            same = ((x[:, k] > cut) == verdicts).mean()
            assert max(same, 1 - same) < 0.9, (name, cut)
    assert maintext.FEATURES[tree.feature[0]] in maintext.AROUND
    assert all(maintext.FEATURES[tree.feature[k]] in maintext.AROUND for k in (tree.left[0], tree.right[0]))


def test_given_pages_without_names(sf_dir):
    """Class, id, role and telling elements taken out of the given pages: most blocks are still told right."""
    import pyarrow.parquet as pq

    tree = maintext.trained()
    right = total = 0
    for page in pq.read_table(f"{sf_dir}/pages.parquet", columns=["html"]).column(0).to_pylist():
        wanted = set(maintext.main_text(page, tree).split("\n\n"))
        blocks = maintext.read_blocks(re.sub(r'\s(?:class|id|role)="[^"]*"', "", unnamed(page or "")))
        keep = tree.predict(maintext.features(blocks))
        right += sum(k == (b.text in wanted) for b, k in zip(blocks, keep, strict=True))
        total += len(blocks)
    assert right / total > 0.75


@pytest.mark.parametrize(
    "page",
    ["<a " * 1_700_000, "<!-" * 1_700_000, '<a "' * 1_250_000, '<a ">" ' * 700_000 + '"', "</script" * 600_000, "<" * 5_000_000, "<div>x" * 200_000, "<!--" * 1_200_000, "<script" * 700_000],
    ids=["tags", "comments", "quotes", "quoted ends", "raw ends", "angles", "nesting", "open comments", "raw"],
)
def test_megabytes_of_open_markup_end(page):
    started = time.process_time()
    maintext.main_text(page, maintext.trained())
    assert time.process_time() - started < 60  # a quadratic scan takes hours


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<script>never closed", ""),
        ("<nav><a href=/news/>News</a></nav><article><p>a <a href=/x/>linked</a> word</p></article>", "a linked word"),
        ('<article><script src="a.js"/>var q = 1;</script><p>kept</p><svg><path d="x"/><g/></svg><p>too</p></article>', "kept\n\ntoo"),
        ("<article><p>1 < 2 and a<b >c</b> <p>end <", "1 < 2 and ac\n\nend <"),
        ("<nav>x</nav><article><h1>T &amp; U</h1><p>One&nbsp;two\n three<p>Four<ul><li>a<li>b</ul></article>", "T & U\n\nOne two three\n\nFour\n\na\n\nb"),
        ("<article><p>a &lt;b&gt; &#233; &#x1F600;</p><!-- no --><style>p{}</style><p>x</p></article><footer>f</footer>", "a <b> é 😀\n\nx"),
        ("<article><p title=\"a>b\">quoted</p><p title='x>broken quote</p></article>", "quoted\n\nbroken quote"),
        ("<article><p>kept</p><div class='ad'>no</div><form><p>no</p></form><section id='comments'><p>no</p></section></article>", "kept"),
        ("<div class='cookie-banner'>We use cookies</div><div id=content><h1>Hello</h1><p>A <a href=x>link</a> here.</p></div>", "Hello\n\nA link here."),
    ],
)
def test_main_text(page, text):
    assert maintext.main_text(page, maintext.trained()) == text


@pytest.mark.parametrize("head", ["<head><title>t</title><meta charset=utf-8>", "<head><head>\n<script>x<p></script><template><p>y</p></template>", "<head><link rel=x><base href=y/>\n<html lang=en>"])
@pytest.mark.parametrize("body", ["<body>", "", "<body class=x>\n"])
def test_head_without_its_end_tag(head, body):
    """A head that is not closed ends where something begins that cannot be in it."""
    page, text = "<article><h1>T</h1><p>One two three four five six seven eight nine ten</p></article>", "T\n\nOne two three four five six seven eight nine ten"
    assert maintext.main_text(f"<html>{head}</head>{body}{page}</body></html>", maintext.trained()) == text
    assert maintext.main_text(f"<html>{head}{body}{page}</body></html>", maintext.trained()) == text
    assert [b.text for b in maintext.read_blocks(f"<html>{head}{body}Some words<p>more</html>")] == ["Some words", "more"]


def test_main_text_rows(spark):
    page = "<article><p>" + "word " * 50_000 + "</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", "<p>x</p>")]
    got = maintext.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars"))
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got.collect()) == [(0, "v", 1), (1, "u", 249_999), (1, "u", 249_999), (2, "", 0)]
    assert got.where("false").count() == 0
    assert maintext.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


# --- licenses ----------------------------------------------------------------------------


def dice(text: str, template: licenses.Template) -> float:
    words = licenses.normalised(text)
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
    return 2 * len(pairs & set(template.bigrams)) / (len(pairs) + len(template.bigrams)) if pairs else 0.0


def test_license_scan(spark, documents):
    templates = licenses.build_templates()
    mit = licenses.TEMPLATES[4][1]
    texts = [
        None, "", "one", "word " * 20_000, "x\nReleased under the MIT License!\ny", "released UNDER the mit license", mit, mit.replace(",", "\n"),
        "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0", "no license at all in this text",
    ]
    rows = [*enumerate(texts), (4, texts[4])]
    got = {r.doc_id: r for r in licenses.license_scan(documents(rows)).collect()}
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        units = [] if text is None else ([(0, text)] if "\n" in text else []) + list(enumerate(text.split("\n"), 1))
        best = min(((-dice(u, t), line, k) for line, u in units for k, t in enumerate(templates) if dice(u, t) >= 0.8), default=None)
        if best is None:
            assert (got[i].license, got[i].dice, got[i].line, got[i].n_matches) == (None, None, None, 0)
        else:
            assert (got[i].license, got[i].dice, got[i].line) == (templates[best[2]].name, round(-best[0], 6), best[1])
    assert got[4].n_matches == 2
    assert licenses.license_scan(documents([])).collect() == []


def test_license_scan_at_the_threshold(spark, documents):
    """Units of exactly 0.8, the smallest and the largest there are for every template."""
    templates, texts = licenses.build_templates(), ["Code is released under the MIT License."]
    for (_, text), template in zip(licenses.TEMPLATES, templates, strict=True):
        a, words = len(template.bigrams), licenses.normalised(text)
        sizes = [b for b in range(1, 3 * a) if (a + b) % 5 == 0 and 2 * (a + b) // 5 <= min(a, b)]
        for b in (sizes[0], sizes[-1]):
            shared = 2 * (a + b) // 5
            n = next(n for n in range(len(words) + 1) if len(set(zip(words[:n], words[1:n], strict=False))) == shared)
            texts.append(" ".join(words[:n] + [f"zz{i}" for i in range(b - shared)]))
            assert dice(texts[-1], template) == 0.8
    got = {r.doc_id: r for r in licenses.license_scan(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        best = min((-dice(text, t), k) for k, t in enumerate(templates))
        assert (got[i].license, got[i].dice, got[i].line, got[i].n_matches) == (templates[best[1]].name, round(-best[0], 6), 1, 1)


def wrapped(text: str, width: int, before: str = "") -> str:
    return "\n".join(before + line for line in textwrap.wrap(text, width - len(before)))


@pytest.mark.parametrize("starts", [3, 64])
def test_license_scan_over_lines(spark, documents, monkeypatch, starts):
    """Runs of lines by brute force; whole licenses, headers and notices wrapped among other text."""
    monkeypatch.setattr(licenses, "STARTS", starts)
    templates = licenses.build_templates()
    texts_of = [t for _, t in licenses.TEMPLATES]
    prose = "\n".join(f"This line number {i} of the text is about the ship and its captain at sea." for i in range(12))
    mit, gpl, bsd, isc = texts_of[17], texts_of[6], texts_of[10], texts_of[18]
    texts = [
        "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + wrapped(mit, 78), "# Notes\n" + wrapped(gpl, 72, " * ") + "\n\n" + prose, prose + "\n\n" + wrapped(bsd, 72, "// ") + "\n" + prose,
        prose + "\n" + wrapped(gpl, 40) + "\n\n" + prose + "\n" + wrapped(bsd, 60) + "\n" + bsd + "\n" + prose, wrapped(isc, 50).replace("\n", "\n\n\n") + "\n" + prose,
        prose + "\n" + wrapped(texts_of[19], 80) + "\n" + prose, prose + "\n" + wrapped(texts_of[20], 80) + "\n" + prose, prose, "word " * 500 + "\n" + wrapped(bsd, 50) + "\n" + "word " * 500,
    ]
    got = {r.doc_id: r for r in licenses.license_scan(documents(list(enumerate(texts)))).collect()}
    names = ["MIT", "GPL-3.0", "BSD-3-Clause", "GPL-3.0", "ISC", "BSD-2-Clause", "BSD-3-Clause", None, "BSD-3-Clause"]
    assert [got[i].license for i in range(len(texts))] == names
    assert [got[i].n_matches for i in range(len(texts))] == [1, 1, 1, 3, 1, 1, 1, 0, 1]
    most = max(t.bounds(0.8)[1] for t in templates) + 1
    for i, text in enumerate(texts):
        lines = [(k, line) for k, line in enumerate(text.split("\n"), 1) if licenses.normalised(line)]
        units = [(0, text), *lines]
        for k in range(len(lines)):
            for j in range(k + 2, len(lines) + 1):
                unit = "\n".join(line for _, line in lines[k:j])
                if len(licenses.normalised(unit)) > most:
                    break
                units.append((lines[k][0], unit))
        best = min(((-dice(u, t), line, k) for line, u in units for k, t in enumerate(templates) if dice(u, t) >= 0.8), default=None)
        assert (best and (templates[best[2]].name, round(-best[0], 6), best[1])) == (best and (got[i].license, got[i].dice, got[i].line))


# --- repetition --------------------------------------------------------------------------


def repetition_by_hand(text: str) -> tuple:
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = collections.Counter(grams)
    inside = {k for i, g in enumerate(grams) if counts[g] > 1 for k in range(i, i + 5)}
    coverage = []
    for n in range(5, 11):
        seen, again = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if gram in seen:
                again |= set(range(i, i + n))
            seen.add(gram)
        coverage.append(sum(len(words[i]) for i in again))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), *coverage)


def test_repetition(spark, documents):
    rng = random.Random(1)
    texts = [None, *odd_texts(40, 2), "a b c d e f g h i j", "x y\nx y\n\n  \nx y\n" * 5, "# | $ a\u2003b"]
    texts += [" ".join(rng.choice(["the", "river", "ran", "é", "on"]) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    texts += [" ".join(str(i) for i in range(3000)), " ".join(str(i % 700) for i in range(3000))]
    docs = documents([*enumerate(texts), (3, texts[3])])
    got = repetition.with_repetition(docs)
    names = [*repetition.BASE, *(f"dup_{n}gram_chars" for n in range(5, 11))]
    for row in got.collect():
        assert tuple(row[n] for n in names) == repetition_by_hand(texts[row.doc_id] or ""), texts[row.doc_id]
        assert row.base_failed == (row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words)
        assert not (row.kept and row.base_failed)
    verdict = {r.doc_id: r.kept for r in got.collect()}
    assert not verdict[0] and verdict[len(texts) - 2] and not verdict[len(texts) - 1]
    assert repetition.with_repetition(documents([])).collect() == []


@pytest.mark.parametrize("texts", [[None], [""], ["", None, ""], ["\n"], [" \n\t"]])
def test_slices_without_words(spark, documents, tokenizer, texts):
    """Whole batches of nothing, through every operator that reads texts."""
    from postsift.llm import jaccard, suffixes

    docs = documents(list(enumerate(texts))).coalesce(1)
    assert [(r.n_words, r.kept) for r in repetition.with_repetition(docs).collect()] == [(0, False)] * len(texts)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.jaccard_join(docs).collect()) == [(i, i, 0) for i in range(len(texts))]
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in suffixes.repeated_passages(docs).collect()} == {i: (len(t or ""), 0) for i, t in enumerate(texts)}
    counts = {r.doc_id: r.n_tokens for r in transducer.token_counts(docs, path=PATH).collect()}
    assert counts == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert sum(r.length for r in packing.pack(docs, path=PATH).collect()) == sum(counts.values()) + len(texts)
    assert [r.license for r in licenses.license_scan(docs).collect()] == [None] * len(texts)


def test_method_rejects_beyond_the_base_rules(spark, documents):
    """Long n-grams told twice: under the base limit by words, over the limit by characters."""
    short = " ".join(f"w{i}" for i in range(100))
    passage = " ".join("abcdefghijklmnopqrstuvwxyz"[i] * 12 for i in range(10))
    row = repetition.with_repetition(documents([(1, f"{short} {passage} {passage}")])).first()
    assert not row.base_failed and not row.kept


# --- token counts, packing ---------------------------------------------------------------


def test_transducer_counts_like_the_library(tokenizer):
    texts = odd_texts(1500, 5)
    machine = transducer.Transducer(transducer.Vocabulary(PATH))
    for i, j, buf, bounds in text_slices(pa.array(texts), 5000):
        want = [len(e.ids) for e in tokenizer.encode_batch(texts[i:j], add_special_tokens=False)]
        assert transducer.count_tokens(buf, bounds, machine).tolist() == want
    machine.restart()
    buf = np.frombuffer(b"again", np.uint8)
    assert transducer.count_tokens(buf, np.array([0, 5]), machine).tolist() == [len(tokenizer.encode("again", add_special_tokens=False).ids)]


def unbroken_texts() -> list[str]:
    rng = random.Random(11)
    words = ["lorem", "ipsum", "extraordinary", "the", "count", "token"]
    return [
        "a" * 9000, "b" * 9001, "=" * 9000, "abc" * 3000, "0123456789" * 900, " " * 9000, "\n" * 5000,
        "".join(rng.choice(words) for _ in range(2000)),
        "".join(rng.choice("abcdeABCDE") for _ in range(9000)),
        "".join(chr(rng.randrange(0x4E00, 0x4E40)) for _ in range(3000)),
        "".join("ab" * rng.randrange(1, 900) + "c" * rng.randrange(1, 900) for _ in range(9)),
        ("x" * 700 + " " + "y" * 2000 + ". ") * 3, "q" * 256 + " " + "q" * 511 + " " + "q" * 513 + "<|endoftext|>" + "q" * 600,
    ]


@pytest.mark.parametrize("chunk, guesses, lead", [(256, 8, 40), (64, 1, 1), (16, 1, 3), (3, 2, 1)])
def test_chunk_maps_give_the_librarys_counts(tokenizer, monkeypatch, chunk, guesses, lead):
    """Texts without the beginning of a piece for many chunks; with few guesses most entries are learnt in the scan."""
    for name, value in (("CHUNK", chunk), ("GUESSES", guesses), ("LEAD", lead)):
        monkeypatch.setattr(transducer, name, value)
    texts = unbroken_texts()
    if chunk < 64:
        texts = [t[:700] for t in texts]
    machine = transducer.Transducer(transducer.Vocabulary(PATH))
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for i, j, buf, bounds in text_slices(pa.array(texts), 30000):
        assert transducer.count_tokens(buf, bounds, machine).tolist() == want[i:j]


def test_maps_of_runs_compose():
    """Two runs of five and three chunks over one table: a chunk adds one to the state, modulo three."""
    keys = np.array([0, 1, 2], np.int64)
    place, room = np.array([0, 1, 2, 3, 4, 0, 1, 2]), np.array([5, 4, 3, 2, 1, 3, 2, 1])
    maps, sizes = transducer.composed(keys, np.array([1, 2, 0]), np.zeros(8, np.int64), place, room)
    assert sizes == [4, 2, 1]
    got = [{(int(n // transducer.BASE), int(n % transducer.BASE)): int(e) for n, e in zip(*m, strict=True)} for m in maps]
    for table, size, begins in zip(got, sizes, ([0], [0, 2, 5], range(8)), strict=True):
        assert table == {(b, s): (s + size) % 3 for b in begins for s in range(3)}


@pytest.mark.parametrize("text", ["a" * 1_000_000, "ab=" * 333_333, "漢" * 300_000])
def test_a_megabyte_without_a_break_is_counted_in_seconds(tokenizer, text):
    """Under two seconds each, 46 s if chunks waited for each other."""
    buf = np.frombuffer(text.encode(), np.uint8)
    machine = transducer.Transducer(transducer.Vocabulary(PATH))
    began = time.process_time()
    got = transducer.count_tokens(buf, np.array([0, len(buf)]), machine).tolist()
    assert time.process_time() - began < 8
    assert got == [len(tokenizer.encode(text, add_special_tokens=False).ids)]


def test_token_counts_rows(spark, documents, tokenizer):
    texts = [None, "", "x " * 600, "<|endoftext|>", "naïve"]
    got = transducer.token_counts(documents([*enumerate(texts), (4, texts[4])]), path=PATH).collect()
    for row in got:
        text = texts[row.doc_id] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)
    assert len(got) == 6
    assert transducer.token_counts(documents([]), path=PATH).collect() == []


def test_pieces_are_the_librarys(tokenizer):
    texts = odd_texts(1500, 6)
    encoder = packing.PieceEncoder(PATH)
    for i, j, buf, bounds in text_slices(pa.array(texts), 5000):
        ids, cuts = encoder.encode(buf, bounds)
        want = [e.ids for e in tokenizer.encode_batch(texts[i:j], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == want


def check_pieces(rows, ids, capacity):
    """Every id in one piece, sequences gapless, full or of a power of two."""
    covered, fill = collections.defaultdict(int), collections.defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == covered[r["doc_id"]] and r["doc_tokens"] == len(own)
        part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(bytes(r["ids"])) == zlib.crc32(part)
        covered[r["doc_id"]] += r["length"]
    assert {d: len(i) for d, i in ids.items()} == dict(covered)
    assert all(n == capacity or n & (n - 1) == 0 and n < capacity for n in fill.values())


def test_packing(spark, documents, tokenizer):
    rng = random.Random(4)
    texts = [None, "", "word " * 9000, *odd_texts(300, 7)] + ["the old mill " * rng.randrange(1, 700) for _ in range(60)]
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    frame = packing.pack(documents(list(enumerate(texts))), path=PATH)
    rows = [r.asDict() for r in frame.collect()]
    check_pieces(rows, ids, 2048)
    assert rows == [r.asDict() for r in frame.collect()]
    assert packing.pack(documents([]), path=PATH).collect() == []
    twice = packing.pack(documents([(7, "a b"), (7, "a b")]), path=PATH).collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens


def test_packer_keeps_levels_in_stock(monkeypatch):
    """The level chosen is the one brute force over all levels finds; cutting loses nothing."""
    monkeypatch.setattr(packing, "MOST_OPEN", 40)
    rng, packer, closed = np.random.default_rng(2), packing.Packer(64), []
    for k in range(3000):
        size = int(rng.integers(1, 64))
        before = packer.level.copy()
        packer.add((k, size), np.full(size, k, np.uint32))
        cost = {}
        for h in range(64 - size + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 64
            cost[h] = int((after[:64] ** 2).sum())
        if packer.level.sum() <= before.sum() + 1 and before.sum() < 40:
            assert int((packer.level[:64] ** 2).sum()) == min(cost.values())
        closed += packer.take()
    packer.close(end=True)
    closed += packer.take()
    assert sum(len(i) for s in closed for _, _, i in s) == sum(d[1] for d in {p[0] for s in closed for p in s})
    assert len({p[0] for s in closed for p in s}) == 3000
