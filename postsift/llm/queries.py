"""The queries of this subpackage and, where SQL can express them, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm import curriculum, jaccard, licenses, maintext, packing, piecewise, prefixtrie, repetition, spellings, suffixes, topk, transducer, urls
from postsift.llm.tables import settled, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


WORD = "[^\\x20\\x09-\\x0D]+"


# --- 1: main text of pages ---------------------------------------------------------------


@query()
def op1_main_text(spark, sf_dir):
    """No SQL: SQL has no reader for markup."""
    return maintext.extract(table(spark, sf_dir, "pages"))


# --- 2: license scans --------------------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


TEMPLATE_ROWS = ", ".join(f"({i}, '{t.name}', {_list(t.bigrams)})" for i, t in enumerate(licenses.build_templates()))

LICENSE_SQL = f"""
    WITH templates AS (SELECT * FROM (VALUES {TEMPLATE_ROWS}) AS t(template, name, pairs)),
    units AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents
      UNION ALL SELECT doc_id, text, 0 FROM documents WHERE contains(text, chr(10))
    ),
    worded AS (SELECT doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM units),
    paired AS (
      SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS pairs
      FROM worded WHERE len(words) > 1
    ),
    scored AS (
      SELECT doc_id, line, template, name, 2.0::DOUBLE * len(list_intersect(p.pairs, t.pairs)) / (len(p.pairs) + len(t.pairs)) AS dice
      FROM paired p JOIN templates t ON len(p.pairs) <= 3 * len(t.pairs) AND len(t.pairs) <= 3 * len(p.pairs)
    ),
    units_matched AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, template) AS n FROM scored WHERE dice >= 0.8),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, line, template) AS k, count(*) OVER (PARTITION BY doc_id) AS n_matches
      FROM units_matched WHERE n = 1
    )
    SELECT d.doc_id, name AS license, round(dice, 6) AS dice, line, coalesce(n_matches, 0) AS n_matches
    FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT * FROM ranked WHERE k = 1) r ON d.doc_id = r.doc_id
"""


@query(LICENSE_SQL)
def op2_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


# --- 3: quality rules by repetition coverage ---------------------------------------------

REPETITION_SQL = f"""
    WITH listed AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    lines AS (
      SELECT doc_id, line, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars,
             row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) s
      WHERE regexp_matches(line, '{WORD}')
    ),
    dup_lines AS (SELECT doc_id, count(*) AS n_dup_lines, sum(chars) AS dup_line_chars FROM lines WHERE n > 1 GROUP BY doc_id),
    spoken AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM listed),
    sizes AS (SELECT doc_id, i, length(word) AS chars FROM spoken),
    ahead AS (
      SELECT doc_id, i, word AS w0, {", ".join(f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY i) AS w{k}" for k in range(1, 10))} FROM spoken
    ),
    grams AS ({" UNION ALL ".join(f"SELECT doc_id, i, {n} AS n, concat_ws(' ', {', '.join(f'w{k}' for k in range(n))}) AS gram FROM ahead WHERE w{n - 1} IS NOT NULL" for n in range(5, 11))}),
    told AS (
      SELECT doc_id, i, n, count(*) OVER (PARTITION BY doc_id, n, gram) > 1 AS twice,
             row_number() OVER (PARTITION BY doc_id, n, gram ORDER BY i) > 1 AS again
      FROM grams
    ),
    spread AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM told WHERE again),
    again AS (
      SELECT s.doc_id, n, sum(chars) AS chars FROM spread s JOIN sizes z ON s.doc_id = z.doc_id AND s.i = z.i GROUP BY s.doc_id, n
    ),
    wide AS (
      SELECT doc_id, {", ".join(f"CAST(coalesce(max(chars) FILTER (WHERE n = {n}), 0) AS BIGINT) AS dup_{n}gram_chars" for n in range(5, 11))}
      FROM again GROUP BY doc_id
    ),
    repeats AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS i FROM told WHERE twice AND n = 5) r GROUP BY doc_id),
    base AS (
      SELECT l.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars,
             {", ".join(f"coalesce(dup_{n}gram_chars, 0) AS dup_{n}gram_chars" for n in range(5, 11))}
      FROM listed l LEFT JOIN dup_lines d ON l.doc_id = d.doc_id LEFT JOIN repeats r ON l.doc_id = r.doc_id LEFT JOIN wide w ON l.doc_id = w.doc_id
    ),
    ruled AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
    SELECT *, NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars
      {" ".join(f"AND 100 * dup_{n}gram_chars <= {most} * word_chars" for n, most in repetition.LIMITS.ngrams)} AS kept
    FROM ruled
"""


@query(REPETITION_SQL)
def op3_repetition_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.with_repetition(documents).drop("text")


# --- 4: exact top-k search ---------------------------------------------------------------

TOP_K_SQL = """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
    )
    SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scored) r
    WHERE rank <= 20
"""


@query(TOP_K_SQL)
def op4_exact_top_k(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(embeddings, F.col("vec_id") % 20 == 0)


# --- 5: URL filters ----------------------------------------------------------------------


@query()
def op5_url_filter(spark, sf_dir):
    """No SQL: the verdict without a rule is a trained model's."""
    return urls.url_filter(table(spark, sf_dir, "pages"))


# --- 6: n-gram Jaccard join --------------------------------------------------------------

JACCARD_SQL = f"""
    WITH RECURSIVE listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    grams AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: hash(words[i:i + 4]))
        WHEN len(words) > 0 THEN [hash(words)] ELSE [] END) AS gram FROM listed
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (
      SELECT a, b, n_both = x.n AND n_both = y.n AS equal FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
      WHERE 10 * n_both >= 8 * (x.n + y.n - n_both)
    ),
    reach(node, root) AS (
      SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a WHERE l.b > r.root
    )
    SELECT d.doc_id, min(r.root) AS class_id, coalesce(max(l.n), 0) AS n_links, least(d.doc_id, coalesce(max(l.equal), d.doc_id)) AS set_id
    FROM documents d JOIN reach r ON d.doc_id = r.node
    LEFT JOIN (SELECT a, count(*) AS n, min(b) FILTER (WHERE equal) AS equal FROM links GROUP BY a) l ON d.doc_id = l.a GROUP BY d.doc_id
"""


@query(JACCARD_SQL)
def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


# --- 7: sum-of-squares packing, 8: token counts -------------------------------------------

TOKENIZER = "byte_bpe_50k.json"


def packed_digest(documents: DataFrame) -> DataFrame:
    pieces = packing.pack(documents, path=public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op7_sum_of_squares_packing(spark, sf_dir):
    """No SQL: the ids come from a tokenizer, and packing is a running state."""
    return packed_digest(table(spark, sf_dir, "documents"))


@query()
def op8_token_counts(spark, sf_dir):
    """No SQL: SQL has no tokenizer."""
    return transducer.token_counts(table(spark, sf_dir, "documents"), path=public_tokenizers.path(TOKENIZER))


# --- 9: mixing sources to target weights -------------------------------------------------

CURRICULUM_SQL = f"""
    WITH sized AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents
    ),
    sources AS (
      SELECT *, 2.0::DOUBLE * source_size / weight AS fills_at FROM (
        SELECT source, source_size, rank, [3, 1, 2][(rank - 1) % 3 + 1] AS weight FROM (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source) a) b
    ),
    levels AS (
      SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY fills_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY fills_at, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here
      FROM sources
    ),
    targets AS (
      SELECT *, CASE WHEN fills_at <= level THEN 2.0::DOUBLE * source_size ELSE weight * level END AS target FROM levels,
        (SELECT here AS level FROM levels WHERE here <= fills_at ORDER BY fills_at, rank LIMIT 1) l
    ),
    placed AS (
      SELECT s.doc_id, s.size, t.source_size, t.target, t.rank,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id, s.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    ),
    takes AS (
      SELECT *, CAST(greatest(least(round(target) - start, size), 0) AS BIGINT) AS first_take,
             CAST(greatest(least(round(target) - source_size - start, size), 0) AS BIGINT) AS second_take
      FROM placed
    ),
    timed AS (
      SELECT *, (start + first_take / 2) / target AS part, [1.5, 0.5, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS a, [0.5, 1.5, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS b
      FROM takes
    )
    SELECT doc_id, size, source_size, target, first_take + second_take AS taken,
      CASE WHEN first_take > 0 THEN round(part * (a + b) / (a + sqrt(a * a + (b * b - a * a) * part)), 6) END AS position
    FROM timed
"""


@query(CURRICULUM_SQL)
def op9_curriculum_mix(spark, sf_dir):
    """The sizes are settled: the mix reads them for the sums and again for the places."""
    documents = table(spark, sf_dir, "documents")
    sized = settled(documents.select("doc_id", "source", curriculum.word_count(F.col("text")).alias("words")))
    mix = curriculum.curriculum_mix(sized, size=F.col("words"))
    return mix.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
        F.round("mix_position", 6).alias("position"),
    )


# --- 10: suffix-array dedup --------------------------------------------------------------


@query()
def op10_suffix_dedup(spark, sf_dir):
    """No SQL: one row per byte of every text is more than SQL can take on whole tables."""
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# --- 11: SentencePiece encoding and decoding ---------------------------------------------


@query()
def op11_sentencepiece(spark, sf_dir):
    """No SQL: the ids come from a tokenizer."""
    coded = piecewise.with_pieces(table(spark, sf_dir, "documents"), path=public_tokenizers.path("piece_bpe_32k.model"))
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "library_agrees",
    )


# --- 12: conversation prefix trie --------------------------------------------------------


def _crc32(data: str) -> str:
    """CRC-32 of a blob, bit by bit: a byte enters with the first of its eight steps."""
    digits = f"hex({data})"
    steps = f"flatten(list_transform(range(0, CAST(len({digits}) / 2 AS BIGINT)), lambda i: [CAST(('0x' || substr({digits}, 2 * i + 1, 2)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce({steps}, lambda a, e: (xor(a, e) >> 1) + 0, CAST(4294967295 AS BIGINT)), 4294967295)".replace(
        "(xor(a, e) >> 1) + 0", "xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)"
    )


TRIE_SQL = f"""
    WITH turns AS (
      SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) g
    ),
    convs AS (SELECT conv_id, {_crc32("encode(CAST(conv_id AS VARCHAR))")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns) d),
    rebuilt AS (
      SELECT conv_id, length(text) AS chars, sha256(concat(length(role), ':', role, text)) AS said, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS pos FROM (
        SELECT c.conv_id, t.role, t.text, t.pos, 0 AS own FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
        UNION ALL SELECT c.conv_id, t.role, t.text, t.pos, 1 FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h) u
    ),
    members AS (
      SELECT conv_id, 0 AS depth, '' AS node, 0 AS chars FROM convs
      UNION ALL SELECT conv_id, pos, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY pos), chars FROM rebuilt
    ),
    ending AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
    nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved FROM members GROUP BY node, depth),
    children AS (SELECT left(node, 64 * (depth - 1)) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    below AS (
      SELECT left(n.node, 64 * a.depth) AS node, CAST(count(*) FILTER (WHERE c.n IS NULL) AS BIGINT) AS leaves, CAST(sum(n.saved) AS BIGINT) AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) n LEFT JOIN children c ON n.node = c.node, LATERAL (SELECT n.up AS depth) a GROUP BY 1
    ),
    ends AS (SELECT m.node, sha256(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id)) AS list FROM members m JOIN ending USING (conv_id, depth) GROUP BY m.node)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.leaves AS n_leaves,
      b.saved AS saved_tokens, coalesce(e.list, sha256('')) AS ends_sha256
    FROM nodes n JOIN below b ON n.node = b.node LEFT JOIN children c ON n.node = c.node LEFT JOIN ends e ON n.node = e.node
    LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, 64 * (n.depth - 1))
"""


@query(TRIE_SQL)
def op12_prefix_trie(spark, sf_dir):
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


# --- 13: spelling variant grouping -------------------------------------------------------

SPELLINGS_SQL = f"""
    WITH RECURSIVE runs AS (
      SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
    ),
    counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
    hashed AS (SELECT run, n, {_crc32("encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM counted),
    slipped AS (
      SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM hashed
    ),
    words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS cut FROM words),
    shorter AS (SELECT word, n, cut, substring(word, 1, cut - 1) || substring(word, cut + 1) AS rest FROM places),
    near AS MATERIALIZED (
      SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
    ),
    best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near),
    formed AS MATERIALIZED (
      SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
      FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1
    ),
    walk(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON k.root = f.word WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, k.root, f.n, f.n_near, f.form_n
    FROM formed f JOIN walk k ON f.word = k.word JOIN formed e ON k.root = e.word WHERE e.form IS NULL
"""


@query(SPELLINGS_SQL)
def op13_spelling_variants(spark, sf_dir):
    return spellings.spelling_variants(table(spark, sf_dir, "documents"))
