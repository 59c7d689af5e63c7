"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.alignment import alignment_digests
from vellum.llm.bpe import bpe_digests
from vellum.llm.common import fold, read_table, row_key, write_shared
from vellum.llm.language import fit_language, identify_language
from vellum.llm.lattice import lattice_scores
from vellum.llm.multiprobe import nearest
from vellum.llm.neardup import near_duplicates
from vellum.llm.packing import pack, word_lengths
from vellum.llm.phrases import collocations
from vellum.llm.quality import fit_quality, score_quality
from vellum.llm.suffixes import repeat_digests
from vellum.llm.tokenfiles import token_digests
from vellum.llm.winnow import edited_fingerprints
from vellum.llm.wrappers import main_texts

Query = Callable[[SparkSession, str], DataFrame]
QUALITY = 0.7


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of every document's ids, read back from token files."""
    return token_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(read_table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_language(docs, where=fold("doc_id", 4) != 2)
    return identify_language(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from three of four folds of the labels."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"), where=fold("doc_id", 4) != 2)
    predicted = (F.col("score") >= QUALITY).cast("int").alias("predicted")
    return score_quality(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", predicted)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every twentieth vector."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice likelihood of every document, learned from six of seven folds."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    scores = lattice_scores(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of words; near duplicates are a cluster."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    keyed = docs.withColumn("row_key", row_key())  # rows without id come after all others, so that they lead no bucket
    classes = near_duplicates(keyed, "row_key").select(F.col("doc_id").alias("row_key"), "class_id").distinct()
    # stored: the join would count the words again whenever adaptive execution plans it anew
    lengths = write_shared(word_lengths(keyed), "lengths")
    rows = lengths.join(classes, "row_key", "left")
    return pack(rows, F.col("words"), F.col("source"), F.col("class_id"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_digests(read_table(spark, sf_dir, "documents"), a, b)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language."""
    return collocations(read_table(spark, sf_dir, "documents"), F.col("lang"), top=2000)


OP12_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), runs AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs
), grams AS (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3]) AS n) WHERE i + n - 1 <= len(w)
), f AS (
  SELECT lang, n, phrase, count(*) AS a, string_split(phrase, ' ') AS parts FROM grams GROUP BY ALL
), candidates AS (
  SELECT * FROM f WHERE n > 1 AND a >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.n, c.a, k, array_to_string(c.parts[1:k], ' ') AS lhs, array_to_string(c.parts[k + 1:], ' ') AS rhs
  FROM candidates c, (SELECT unnest([1, 2]) AS k) WHERE k < c.n
), scored AS (
  SELECT c.lang, c.phrase, c.n, c.a, c.k, x.a AS l, y.a AS r,
    (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lhs JOIN f y ON y.lang = c.lang AND y.phrase = c.rhs
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) AS phrase, a FROM candidates WHERE n = 3
), kept AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM held h WHERE h.lang = b.lang AND h.phrase = b.phrase AND 100 * h.a >= 50 * b.a)
), totals AS (
  SELECT lang, sum(a) AS n FROM f WHERE n = 1 GROUP BY lang
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept
)
SELECT lang, rank, phrase, a, l, r, totals.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without the 50-byte strings that an earlier one holds."""
    return repeat_digests(read_table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT *, length(h) // 2 AS n FROM texts
), chunks AS (
  SELECT row, doc_id, least(1000, n - 49 - c) AS places, c, substr(h, 2 * c + 1, 2 * 1049) AS part
  FROM (SELECT *, unnest(range(0, n - 49, 1000)) AS c FROM sized)
), strings AS (
  SELECT row, doc_id, c + i AS i, substr(part, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, places)) AS i FROM chunks)
), firsts AS (
  SELECT s, min(doc_id) AS holder FROM strings GROUP BY s HAVING count(*) > 1
), gone AS (
  SELECT row, i FROM strings JOIN firsts USING (s) WHERE holder < doc_id
), edges AS (
  SELECT row, i, coalesce(i - lag(i) OVER (PARTITION BY row ORDER BY i) > 50, true) AS new FROM gone
), numbered AS (
  SELECT row, i, sum(new::INT) OVER (PARTITION BY row ORDER BY i) AS span FROM edges
), spans AS (
  SELECT row, span, min(i) AS lo, max(i) + 50 AS hi FROM numbered GROUP BY row, span
), gaps AS (
  SELECT row, span, lo, hi, coalesce(lag(hi) OVER (PARTITION BY row ORDER BY lo), 0) AS after FROM spans
), cut AS (
  SELECT row, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(g.hi) AS hi,
    string_agg(substr(h, 2 * after + 1, 2 * (lo - after)), '' ORDER BY lo) AS kept
  FROM gaps g JOIN sized USING (row) GROUP BY row
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * hi + 1), h))) AS kept_sha256
FROM sized LEFT JOIN cut USING (row)
"""

QUERIES: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_winnowing": op2_winnowing,
    "op3_token_files": op3_token_files,
    "op4_main_text": op4_main_text,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_neighbours": op7_neighbours,
    "op8_lattice": op8_lattice,
    "op9_bpe": op9_bpe,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_phrases": op12_phrases,
    "op13_suffixes": op13_suffixes,
}

#: The other operators can't be expressed in SQL; tests hold them against brute force, round trips and held-out labels.
ORACLES: dict[str, str] = {"op12_phrases": OP12_SQL, "op13_suffixes": OP13_SQL}
