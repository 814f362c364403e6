"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import bytebpe, chat, decontaminate, extract, hnsw, lexical, linelinks, lm, mixing, prefixtrie, quality, simhash, toxicity
from tallyfold.llm.common import is_held_out, labelled_sample, table
from tallyfold.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@_register
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_register
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["taken"])
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@_register
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL["op4_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@_register
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@_register
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model_scores(table(spark, sf_dir, "documents"), is_held_out("doc_id", 10, 0))


@_register
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@_register
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(own)))


def toxic_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return labelled_sample(docs, labels, "doc_id", "text", "toxic", ~is_held_out("key", 5, 0), toxicity.SAMPLE_ROWS)


@_register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.toxicity_scores(docs.select("doc_id", "text"), toxic_labels(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "row.doc_id",
        is_held_out("row.doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_register
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    usable = ~is_held_out("key", 3, 1)
    labelled = labelled_sample(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", usable, quality.SAMPLE_ROWS)
    scored = quality.quality_scores(docs, labelled)
    return scored.select(
        "doc_id", is_held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linelinks.linked_documents(table(spark, sf_dir, "documents")).drop("text_key")


_TERMS = _WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")

SQL["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS nn, sum(len(w)) AS ll FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY 1, 2),
df AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
       FROM tf, total GROUP BY term, nn),
m AS (SELECT r, doc_id, CAST(50 + (50 * len(w) * nn) // ll AS BIGINT) AS m FROM d, total WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS item, item_id, w FROM (SELECT DISTINCT item_id, text, {_TERMS} AS w FROM benchmark)),
asked AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM i),
scores AS (SELECT item, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scores) WHERE rank <= 50"""


@_register
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = staged(lexical.query_terms(table(spark, sf_dir, "benchmark")), "items")
    counts = staged(lexical.term_counts(table(spark, sf_dir, "documents")), "term_counts")
    index = lexical.build_index(counts, items.select(F.explode("terms").alias("term")))
    return lexical.search(index, items, k=50).drop("item")


# DuckDB has no crc32: its table-free form over the digits of the id.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, digit: list_reduce(list_prepend(xor(crc, digit), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""

SQL["op12_prefix_trie"] = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) AS p,
             coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, {_CRC32} % 6 AS h, c - c % 100 AS b FROM (SELECT DISTINCT c FROM t)),
turns AS (SELECT h.c, 0 AS part, p, role, text FROM h JOIN t ON t.c = h.b AND p <= h
          UNION ALL SELECT h.c, 1, p, role, text FROM h JOIN t ON t.c = h.c AND p > h),
seq AS (SELECT h.c, coalesce(list({{'role': role, 'text': text}} ORDER BY part, p) FILTER (p IS NOT NULL), []) AS s
        FROM h LEFT JOIN turns USING (c) GROUP BY h.c),
nodes AS (SELECT s[1:d] AS n, d, min(c) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256
          FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seq) GROUP BY ALL),
kids AS (SELECT n[1:d - 1] AS n, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
tree AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (n, d)),
sums AS (SELECT u.n, u.d, sum((v.n_children = 0)::BIGINT) AS n_leaves,
           sum((v.n_convs - 1) * CASE WHEN v.d = 0 THEN 0 ELSE length(v.n[v.d].text) END) AS saved_tokens
         FROM tree u JOIN tree v ON v.d >= u.d AND v.n[1:u.d] = u.n GROUP BY ALL)
SELECT tree.conv_id, CAST(tree.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, tree.n_convs, tree.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, tree.ends_sha256
FROM tree JOIN sums USING (n, d) LEFT JOIN nodes up ON tree.d > 0 AND up.d = tree.d - 1 AND up.n = tree.n[1:tree.d - 1]"""


@_register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(prefixtrie.ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    rebuilt, convs = prefixtrie.with_shared_heads(turns)
    return prefixtrie.prefix_trie(staged(rebuilt, "rebuilt"), convs)


@_register
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bytebpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return bytebpe.decode(encoded).select(
        "row.row.doc_id",
        F.size("row.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("row.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
