"""The operators over the given tables, with production parameters, and SQL where it has words."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from grantchron.llm import (
    byte_bpe,
    collocations,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    mixing,
    ngram_join,
    private_data,
    quality,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    token_counts,
)

MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def for_whole_texts(spark: SparkSession) -> SparkSession:
    """Arrow batches of 1,000 rows at most: whole texts make Spark's 10,000 some 100 MB a task."""
    if int(spark.conf.get(ARROW_ROWS)) > 1_000:
        spark.conf.set(ARROW_ROWS, "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return for_whole_texts(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), MULTI_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", "p_text", "p_known", "score", "keep")


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.words("text").alias("n_words"), F.xxhash64("text").alias("digest")
    )
    mixed = mixing.mix(docs, size=F.col("n_words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _by_place(spans: Column, kinds: tuple[str, ...]) -> Column:
    """By start, then by the order of kinds."""
    order = F.create_map(*(F.lit(x) for pair in zip(kinds, range(len(kinds)), strict=True) for x in pair))
    keyed = F.transform(
        spans,
        lambda s: F.struct(s.start.alias("start"), order[s.kind].alias("at"), s.kind.alias("kind"), s.end.alias("end")),
    )
    return F.array_sort(keyed)


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("fixed", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in secret_scan.FIXED),
        F.sha2(_listed(F.col("fixed")), 256).alias("base_sha256"),
        _listed(_by_place(F.concat("fixed", "added"), secret_scan.KINDS)).alias("spans"),
    )


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BPE)


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
"""


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(damaged, present_col="present"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM pieces, (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT lang, k, phrase, f AS a, str_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
  FROM counts WHERE k >= 2 AND f >= 10),
scores AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f * y.f) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
candidates AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[cut:cut + 1], ' ') AS phrase, max(a) AS longer FROM cuts WHERE k = 3 GROUP BY ALL),
ranked AS (
  SELECT c.lang, c.phrase, a, l, r, score,
    row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank
  FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_data.private_data(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in private_data.KINDS),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(_by_place(F.concat("base", "added"), private_data.KINDS)).alias("spans"),
    )


_WORDS = r"""
words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"""

#: Who reaches whom over the table links (a, b), and the least of them.
_REACHED = """
reached AS (
  SELECT id AS a, id AS b FROM nodes
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
parts AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)"""

ORACLES["op1_ngram_join"] = f"""
WITH RECURSIVE {_WORDS.strip()},
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y USING (g)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b, c.n = s.n AND c.n = t.n AS same FROM common c
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE c.n / (s.n + t.n - c.n) >= 0.8),
nodes AS (SELECT doc_id AS id FROM documents),{_REACHED},
classes AS (SELECT a AS id, min(b) AS least FROM links WHERE same GROUP BY a)
SELECT id AS doc_id, least(id, coalesce(least, id)) AS class_id, coalesce(n_links, 0) AS n_links,
  component_id, id = component_id AS kept
FROM parts LEFT JOIN counts USING (id) LEFT JOIN classes USING (id)
"""

ORACLES["op3_embedding_dedup"] = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id AS id, v, sqrt(list_dot_product(v, v)) AS norm
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)),
links AS (
  SELECT x.id AS a, y.id AS b FROM vectors x JOIN vectors y ON x.id <> y.id
  WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.95),
nodes AS (SELECT id FROM vectors),{_REACHED}
SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, id = component_id AS kept
FROM parts LEFT JOIN counts USING (id)
"""

ORACLES["op8_substring_dedup"] = f"""
WITH {_WORDS.strip()},
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(20)) AS p FROM later),
each_word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLES["op10_suffix_dedup"] = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, len(h) // 2 AS n FROM texts),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM sized WHERE n >= 100)),
later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
marked AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER w + 100, true)::INT AS new
  FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS s, max(i) + 100 AS e FROM numbered GROUP BY ALL),
gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM spans
  UNION ALL SELECT doc_id, max(e), max(n) FROM spans JOIN sized USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS t
  FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) AS n_spans, sum(e - s)::BIGINT AS n_removed FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM sized LEFT JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""
