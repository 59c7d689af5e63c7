"""Column jobs: identifiers, abstracts, documents, payloads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vellum.functions import ids, text
from vellum.operators import documents as docs
from vellum.operators import payloads
from vellum.operators.language import tag_language
from vellum.plans import fixtures as fx
from vellum.plans.nested import inverted_works, nested_works, torn_works
from vellum.plans.registry import job
from vellum.session import widen


@job(
    "prj_normalise_ids",
    """
    SELECT doc_id,
           CAST(4394000000 + doc_id AS STRING) AS number,
           concat('W', CAST(doc_id AS STRING)) AS by_length,
           CASE WHEN source IN ('src3', 'src11', 'src17') THEN NULL
                ELSE concat('10.5555/D', CAST(doc_id AS STRING)) END AS doi,
           concat('two ', lang, ' and ', source) AS many,
           CASE WHEN length(source) > 3 THEN CAST(substring(source, 4) AS BIGINT) END AS source_number,
           CASE WHEN length(source) + length(lang) > 20 THEN source END AS too_short
    FROM documents
    """,
)
def prj_normalise_ids(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    raw = {c: F.expr(fx.spark_sql(fx.WORKS[c])) for c in ("id", "doi")}
    many = F.concat(F.lit("two https://orcid.org/"), F.col("lang"), F.lit(" and https://ror.org/"), F.col("source"))
    # work numbers are past 32 bits
    number = F.concat(F.lit("https://openalex.org/W"), (F.lit(4394000000) + F.col("doc_id")).cast("string"))
    return docs.select(
        "doc_id",
        ids.parse_id(number, "https://openalex.org/W").cast("string").alias("number"),
        ids.strip_id(raw["id"]).alias("by_length"),
        ids.strip_url(raw["doi"]).alias("doi"),
        ids.strip_url(many).alias("many"),
        ids.parse_id(F.col("source"), "src").alias("source_number"),
        ids.strip_id(F.concat("source", "lang")).alias("too_short"),
    )


# Letters beyond the text's own, and what a DOI keeps of them.
OTHER_LETTERS = {"de": "Việt Łódź", "en": "Θεωρία Ψυχή", "es": "Щёлково Юля", "fr": "漢 œuvre"}
PLAIN_LETTERS = {"de": "Viet Lodz", "en": "Theoria Psukhe", "es": "Shchiolkovo Iulia", "fr": "漢 oeuvre"}


@job(
    "prj_clean_doi",
    r"""
    WITH raw AS (SELECT doc_id, lang, concat('  10.5555//', lang, '=', text, '+a[b]:"c"\;?q=1&', source, ' ') AS doi
                 FROM documents)
    SELECT doc_id,
           concat(replace(replace(strip_accents(regexp_replace(trim(doi), '\?[^\n]*|[%:="+;\[\]\\]', '', 'g')),
                   'ß', 'ss'), '//', '/'), '/', CASE lang <CASES> END) AS doi
    FROM raw
    """.replace("<CASES>", " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PLAIN_LETTERS.items())),
)
def prj_clean_doi(spark, sf_dir):
    raw = F.concat(
        F.lit("  10.5555//"), F.col("lang"), F.lit("="), F.col("text"), F.lit('+a[b]:"c"\\;?q=1&'), F.col("source"),
        F.lit(" "),
    )
    other = F.create_map(*[F.lit(x) for pair in OTHER_LETTERS.items() for x in pair])[F.col("lang")]
    cleaned = F.concat(ids.clean_doi(raw), F.lit("/"), ids.clean_doi(other))
    return widen(fx.table(spark, sf_dir, "documents")).select("doc_id", cleaned.alias("doi"))


@job(
    "prj_rebuild_abstract",
    r"""
    SELECT doc_id, array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' ') AS abstract FROM documents
    """,
)
def prj_rebuild_abstract(spark, sf_dir):
    index = inverted_works(spark, sf_dir)
    return index.select("doc_id", text.rebuild_positional(F.col("abstract_inverted_index")).alias("abstract"))


@job(
    "prj_rebuild_torn",
    """
    WITH <<lines>>, placed AS (
      SELECT doc_id, concat('t', length(line)) AS t, i, n_lines AS n,
             CASE WHEN i % 5 = 2 THEN i - 1 WHEN i % 5 = 4 THEN i + 100000 ELSE i END AS p FROM lines),
    keyed AS (SELECT *, min(i) OVER (PARTITION BY doc_id, t) AS k FROM placed),
    slots AS (SELECT doc_id, p, arg_max(t, k) AS t FROM keyed WHERE p < n GROUP BY doc_id, p),
    wide AS (SELECT l.doc_id, l.i, COALESCE(s.t, '') AS t FROM lines l LEFT JOIN slots s ON s.doc_id = l.doc_id AND s.p = l.i)
    SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS abstract FROM wide GROUP BY doc_id
    """,
)
def prj_rebuild_torn(spark, sf_dir):
    index = torn_works(spark, sf_dir)
    return index.select("doc_id", text.rebuild_positional(F.col("abstract_inverted_index")).alias("abstract"))


@job(
    "agg_rebuild_abstract_sorted",
    r"""
    SELECT doc_id, array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' ') AS abstract FROM documents
    """,
)
def agg_rebuild_abstract_sorted(spark, sf_dir):
    index = inverted_works(spark, sf_dir)
    return index.select("doc_id", text.rebuild_sorted(F.col("abstract_inverted_index")).alias("abstract"))


@job(
    "prj_title_abstract",
    """
    WITH <<works>>
    SELECT doc_id, CASE WHEN title IS NULL AND abstract IS NULL THEN NULL
                        ELSE concat(COALESCE(title, ''), ' ', COALESCE(abstract, '')) END AS title_abstract
    FROM works
    """,
)
def prj_title_abstract(spark, sf_dir):
    joined = text.title_abstract(F.col("title"), F.col("abstract")).alias("title_abstract")
    return fx.works(spark, sf_dir).select("doc_id", joined)


@job(
    "prj_min_abstract_len",
    """
    WITH <<request>>
    SELECT record_id, CASE WHEN length(abstract) >= 1000 THEN abstract END AS abstract FROM request
    """,
)
def prj_min_abstract_len(spark, sf_dir):
    return fx.request(spark, sf_dir).select("record_id", text.at_least(F.col("abstract"), 1000).alias("abstract"))


@job(
    "prj_clean_list",
    r"""
    WITH parts AS (
      SELECT doc_id, list_filter(list_transform(string_split(text, '. '),
                                                lambda x: translate(x, ',"''', '')), lambda x: length(x) > 0) AS items
      FROM documents)
    SELECT doc_id, CASE WHEN len(items) > 0 THEN array_to_string(items, '|') END AS items FROM parts
    """,
)
def prj_clean_list(spark, sf_dir):
    sentences = F.split("text", r"\. ")
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(text.clean_list(sentences), "|").alias("items")
    )


@job(
    "prj_json_first_match",
    """
    WITH <<request>>
    SELECT record_id, wrapper,
           CASE WHEN raw IS NULL THEN NULL
                WHEN wrapper = 'WOS' THEN concat(CASE WHEN substr(raw, strpos(raw, '"type":"openalexworkID"'), 5) = '"type'
                     AND strpos(raw, 'openalexworkID') > 0 THEN '10.5555/S' ELSE '10.5555/R' END,
                     CAST(record_id // 4 AS STRING))
                WHEN wrapper = 'PUBMED' AND strpos(raw, '"doi"') > 0
                     THEN concat('10.5555/P', CAST(record_id // 4 AS STRING)) END AS raw_doi,
           CASE WHEN wrapper = 'WOS' AND strpos(raw, 'openalexworkID') > 0
                THEN concat('10.5555/R', CAST(record_id // 4 AS STRING)) END AS wos_work_id
    FROM request
    """,
)
def prj_json_first_match(spark, sf_dir):
    raw, wrapper = F.col("raw"), F.col("wrapper")
    return fx.request(spark, sf_dir).select(
        "record_id",
        "wrapper",
        F.when(wrapper == "WOS", payloads.wos_identifier(raw, "xref_doi", "doi"))
        .when(wrapper == "PUBMED", payloads.pubmed_doi(raw))
        .alias("raw_doi"),
        F.when(wrapper == "WOS", payloads.wos_identifier(raw, "openalexworkID")).alias("wos_work_id"),
    )


@job(
    "prj_unify_payloads",
    """
    WITH letters AS (SELECT doc_id, source, lang, translate(text, '<>&', '') AS t FROM documents)
    SELECT doc_id, w.wrapper AS wrapper, concat('About ', source) AS title,
           CASE WHEN w.wrapper = 'PUBMED' THEN concat(t, chr(10), chr(10), 'End of ', lang) ELSE t END AS abstract,
           concat('10.5555/D', CAST(doc_id AS STRING)) AS doi,
           CASE WHEN w.wrapper = 'SCOPUS' THEN concat('2-s2.0-', CAST(doc_id AS STRING)) END AS scopus_id,
           CASE WHEN w.wrapper = 'DIMENSIONS' THEN concat('pub.', CAST(doc_id AS STRING)) END AS dimensions_id,
           CASE WHEN w.wrapper = 'PUBMED' THEN CAST(doc_id AS STRING) END AS pubmed_id, CAST(NULL AS STRING) AS raw
    FROM letters CROSS JOIN (VALUES ('SCOPUS'), ('DIMENSIONS'), ('PUBMED')) AS w(wrapper)
    UNION ALL
    SELECT doc_id, 'OTHER', NULL, NULL, NULL, NULL, NULL, NULL, t FROM letters
    """,
)
def prj_unify_payloads(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.translate("text", "<>&", "").alias("t"),
        F.concat(F.lit("10.5555/D"), F.col("doc_id").cast("string")).alias("doi"),
        F.concat(F.lit("About "), F.col("source")).alias("title"),
    )
    number = F.col("doc_id").cast("string")
    scopus = F.to_json(
        F.struct(
            F.col("title").alias("dc:title"), F.col("t").alias("dc:description"), F.col("doi").alias("prism:doi"),
            F.concat(F.lit("2-s2.0-"), number).alias("eid"),
        )
    )
    dimensions = F.to_json(
        F.struct("title", F.col("t").alias("abstract"), "doi", F.concat(F.lit("pub."), number).alias("id"))
    )
    pubmed = F.concat(
        F.lit("<PubmedArticle><PMID>"), number, F.lit("</PMID><ArticleTitle>"), F.col("title"),
        F.lit("</ArticleTitle><Abstract><AbstractText>"), F.col("t"), F.lit("</AbstractText><AbstractText>End of "),
        F.col("lang"),
        F.lit('</AbstractText></Abstract><ArticleIdList><ArticleId IdType="pii">1</ArticleId><ArticleId IdType="doi">'),
        F.col("doi"), F.lit("</ArticleId></ArticleIdList></PubmedArticle>"),
    )
    cases = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("wrapper"), raw.alias("raw"))
                for name, raw in (("SCOPUS", scopus), ("DIMENSIONS", dimensions), ("PUBMED", pubmed), ("OTHER", F.col("t")))
            ]
        )
    )
    unified = payloads.unify_all(documents.select("doc_id", cases))
    # the payload of a source without adapter is all there is of it
    return unified.withColumn("raw", F.when(F.col("wrapper") == "OTHER", F.col("raw"))).drop("wos_id")


# A place and an author of the nested works as JSON text without null fields.
_SOURCE_JSON = """concat('"source":{"id":"https://openalex.org/S', length(line) % 50, '","display_name":"source ', length(line) % 50,
             '","host_organization":"https://openalex.org/P', lang, '","host_organization_name":"host ', lang,
             '","host_organization_lineage":["https://openalex.org/P', lang, '"],"is_in_doaj":false,"is_oa":',
             source = 'src9', ',"issn":["1234-5678"],"issn_l":"1234-5678","type":"journal"},')"""
_LOCATION_JSON = f"""concat('{{"is_oa":', source = 'src9', ',"is_primary":', is_primary,
             ',"landing_page_url":"http://example.org/', doc_id, '/', i, '",', CASE WHEN line <> '' THEN {_SOURCE_JSON} ELSE '' END,
             CASE WHEN length(line) % 3 > 0 THEN concat('"pdf_url":"pdf', length(line) % 3, '",') ELSE '' END,
             '"version":"publishedVersion"}}')"""
_INSTITUTION_JSON = """concat('{"id":"https://openalex.org/I', length(s), '","display_name":"institution ', length(s),
             '","country_code":"', upper(lang), '","type":"education"}')"""
_AUTHOR_JSON = f"""concat('{{"author":{{', CASE WHEN line = '' THEN '' ELSE concat('"id":"https://openalex.org/A', length(line), '",') END,
             '"display_name":"name ', length(line), '"}},"author_position":"',
             CASE WHEN i = 0 THEN 'first' WHEN i = n_lines - 1 THEN 'last' ELSE 'middle' END, '","countries":["', upper(lang),
             '"],"institutions":[', array_to_string(list_transform(list_filter(string_split_regex(line, '[.] '), lambda s: s <> ''),
               lambda s: {_INSTITUTION_JSON}), ','), '],"is_corresponding":', i = 0, ',"raw_affiliation_string":', to_json(line),
             ',"raw_affiliation_strings":[', to_json(line), '],"raw_author_name":', to_json(split_part(line, ' ', 1)), '}}')"""


@job(
    "prj_work_to_document",
    rf"""
    WITH <<lines>>, keyed AS (
      SELECT l.*, l.line <> '' AND p.line <> '' AND length(l.line) % 50 = length(p.line) % 50
                  AND length(l.line) % 3 = length(p.line) % 3 AS is_primary
      FROM lines l JOIN lines p ON p.doc_id = l.doc_id AND p.i = 0),
    per AS (
      SELECT doc_id, concat('[', string_agg({_AUTHOR_JSON}, ',' ORDER BY i), ']') AS authorships,
             concat('[', string_agg({_LOCATION_JSON}, ',' ORDER BY i), ']') AS locations
      FROM keyed GROUP BY doc_id),
    d AS (SELECT *, split_part(text, chr(10), 1) AS title,
                 NULLIF(array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' '), '') AS abstract FROM documents)
    SELECT concat('W', CAST(doc_id AS STRING)) AS id, title, abstract, concat(title, ' ', COALESCE(abstract, '')) AS title_abstract,
           authorships,
           CASE WHEN source IN ('src1', 'src2') THEN NULL
                ELSE concat('{{"volume":"', source, '","first_page":"', CAST(n_chars AS STRING), '"}}') END AS biblio,
           CAST(n_chars AS INT) AS cited_by_count, '2024-01-01T10:00:00' AS created_date,
           concat('https://doi.org/10.5555/D', doc_id) AS doi, CAST(doc_id AS STRING) AS mag, CAST(NULL AS STRING) AS pmid,
           CAST(NULL AS STRING) AS pmcid,
           CASE WHEN source = 'src4' THEN NULL ELSE concat('["', source, '","', lang, '"]') END AS indexed_in,
           source = 'src9' AS is_oa, false AS is_paratext, source = 'src13' AS is_retracted, false AS is_published,
           true AS is_accepted, lang AS language, CASE WHEN title = '' THEN NULL ELSE concat('host ', lang) END AS publisher,
           CASE WHEN title = '' THEN NULL ELSE concat('https://openalex.org/P', lang) END AS publisher_id, locations,
           '2024-01-01' AS publication_date, CAST(1990 + n_chars % 36 AS INT) AS publication_year, 'article' AS type,
           '2024-02-01' AS updated_date, source = 'src6' AS is_xpac,
           CASE WHEN abstract IS NOT NULL THEN 'OpenAlex' END AS abstract_source, CAST(NULL AS STRING) AS abstract_date
    FROM d JOIN per USING (doc_id)
    """,
)
def prj_work_to_document(spark, sf_dir):
    documents = docs.to_documents(nested_works(spark, sf_dir))
    return documents.withColumn("abstract_date", F.col("abstract_date").cast("string"))


@job(
    "prj_primary_location",
    """
    WITH <<lines>>, keyed AS (
      SELECT doc_id, i, line, CAST(length(line) % 50 AS STRING) AS s,
             CASE WHEN length(line) % 3 = 0 THEN NULL ELSE concat('pdf', CAST(length(line) % 3 AS STRING)) END AS pdf
      FROM lines)
    SELECT concat('W', CAST(k.doc_id AS STRING)) AS work_id, k.i AS place,
           k.line <> '' AND p.line <> '' AND k.s = p.s AND k.pdf IS NOT DISTINCT FROM p.pdf AS is_primary
    FROM keyed k JOIN keyed p ON p.doc_id = k.doc_id AND p.i = 0
    """,
)
def prj_primary_location(spark, sf_dir):
    works = nested_works(spark, sf_dir)
    flags = F.transform("locations", lambda loc: docs.is_primary(loc, F.col("primary_location")))
    return works.select(ids.strip_id(F.col("id")).alias("work_id"), F.posexplode(flags).alias("place", "is_primary"))


@job(
    "prj_encode_nested",
    """
    WITH <<lines>>, per AS (
      SELECT doc_id,
             string_agg(concat('{"funder":"F', CAST(length(line) AS STRING), '","funder_display_name":null,"award_id":"',
                               source, '"}'), ',' ORDER BY i) FILTER (WHERE line <> '') AS g,
             string_agg(concat('{"is_major_topic":', CASE WHEN i = 0 THEN 'true' ELSE 'false' END,
                               ',"descriptor_ui":"D', CAST(length(line) AS STRING),
                               '","descriptor_name":"', lang, '","qualifier_ui":"Q', CAST(i AS STRING),
                               '","qualifier_name":null}'),
                        ',' ORDER BY i) AS m
      FROM lines GROUP BY doc_id)
    SELECT concat('W', CAST(doc_id AS STRING)) AS work_id, concat('[', g, ']') AS grants_json,
           concat('[', m, ']') AS mesh_json
    FROM per
    """,
)
def prj_encode_nested(spark, sf_dir):
    return docs.encoded_nested(nested_works(spark, sf_dir)).select(
        ids.strip_id(F.col("id")).alias("work_id"), F.col("grants").alias("grants_json"),
        # a list that is not there joins to '[]' in the oracle
        F.col("mesh").alias("mesh_json"),
    ).withColumn("grants_json", F.coalesce("grants_json", F.lit("[]")))


# A stand-in for a trained model: how many function words of a language a text holds.
FUNCTION_WORDS = {"de": "der|die|das|und", "en": "the|and|of|to", "es": "el|los|que|y", "fr": "le|la|les|et"}


def count_function_words(texts: pd.Series, k: int):
    """Languages by their share of function words, best first, then by name."""
    hits = pd.DataFrame(
        {
            lang: texts.str.lower().str.count(rf"(?:^| )(?:{words})(?= |$)").astype(float)
            for lang, words in FUNCTION_WORDS.items()
        }
    )
    shares = hits.to_numpy() / (hits.to_numpy().sum(axis=1, keepdims=True) + 1.0)
    order = np.argsort(-shares, axis=1, kind="stable")[:, :k]  # the columns are in the order of their names
    names = hits.columns.to_numpy()
    return names[order].tolist(), np.take_along_axis(shares, order, axis=1).tolist()


@job(
    "prj_language_tag",
    """
    WITH <<works>>, padded AS (
      SELECT doc_id, title,
             replace(concat(' ', lower(replace(title, chr(10), ' ')), ' '), ' ', '  ') AS t FROM works),
    counted AS (
      SELECT doc_id, title, w.lang, CAST(len(regexp_extract_all(t, concat(' (', w.words, ') '))) AS DOUBLE) AS n
      FROM padded CROSS JOIN (VALUES ('de', 'der|die|das|und'), ('en', 'the|and|of|to'), ('es', 'el|los|que|y'),
                                     ('fr', 'le|la|les|et')) AS w(lang, words)),
    ranked AS (
      SELECT doc_id, title, lang, n / (sum(n) OVER (PARTITION BY doc_id) + 1) AS score,
             row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS r
      FROM counted)
    SELECT doc_id,
           CASE WHEN any_value(title) IS NULL THEN 'en' ELSE max(lang) FILTER (WHERE r = 1) END AS lang_1,
           CASE WHEN any_value(title) IS NULL THEN 1.0 ELSE max(score) FILTER (WHERE r = 1) END AS score_1,
           CASE WHEN any_value(title) IS NULL THEN NULL ELSE max(lang) FILTER (WHERE r = 2) END AS lang_2,
           CASE WHEN any_value(title) IS NULL THEN NULL ELSE max(score) FILTER (WHERE r = 2) END AS score_2
    FROM ranked GROUP BY doc_id
    """,
)
def prj_language_tag(spark, sf_dir):
    titles = fx.works(spark, sf_dir).select("doc_id", "title")
    return tag_language(titles, "title", count_function_words).select(
        "doc_id", "lang_1", F.round("score_1", 9).alias("score_1"), "lang_2", F.round("score_2", 9).alias("score_2")
    )


@job(
    "flt_collection",
    """
    WITH <<works>>
    SELECT doc_id, w.c AS collection FROM works CROSS JOIN (VALUES ('all'), ('base'), ('xpac')) AS w(c)
    WHERE w.c = 'all' OR (w.c = 'xpac') = COALESCE(is_xpac, false)
    """,
)
def flt_collection(spark, sf_dir):
    works = fx.works(spark, sf_dir).select("doc_id", "is_xpac")
    parts = [
        docs.in_collection(works, c).select("doc_id", F.lit(c).alias("collection")) for c in ("all", "base", "xpac")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@job(
    "flt_min_two_ids",
    """
    WITH <<queue>>
    SELECT queue_id FROM queue
    WHERE (CASE WHEN openalex_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN doi IS NULL THEN 0 ELSE 1 END)
          + (CASE WHEN pubmed_id IS NULL THEN 0 ELSE 1 END) > 1
    """,
)
def flt_min_two_ids(spark, sf_dir):
    from vellum.operators.matching import with_enough_ids

    return with_enough_ids(fx.queue(spark, sf_dir), ("openalex_id", "doi", "pubmed_id")).select("queue_id")
