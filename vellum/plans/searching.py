"""Text search."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import stemming
from vellum.functions.text import STOP_WORDS, highlight
from vellum.operators import reports, search, textindex
from vellum.operators.search import And, AnyOf, Near, Not, Or, Phrase, Term
from vellum.plans import fixtures as fx
from vellum.plans.nested import stored
from vellum.plans.registry import job
from vellum.session import scratch_path, widen

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_INDEXED = f"<<tokens>>, t AS (SELECT * FROM tokens WHERE term NOT IN ({_STOP}))"


def _index(spark, sf_dir, name, **options):
    """A stored index of the texts, written once per session, as every search reads it."""

    def write(path):
        search.write_index(search.build_postings(widen(fx.table(spark, sf_dir, "documents")), "doc_id", "text", **options), path)

    return stored(spark, sf_dir, name, write)


def postings(spark, sf_dir):
    return _index(spark, sf_dir, "index")


def full_postings(spark, sf_dir):
    """With the stop words in, which make the longest lists."""
    return _index(spark, sf_dir, "index_full", stop_words=())


_BUILT: dict[tuple[str, str], str] = {}


def text_index(spark, sf_dir):
    """A stored index with a dictionary, built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        root = scratch_path(spark, "text_index")
        textindex.TextIndex(spark, root, buckets=32).add(widen(fx.table(spark, sf_dir, "documents")), "doc_id", "text")
        _BUILT[key] = root
    return textindex.TextIndex(spark, _BUILT[key])


def stems(spark, sf_dir):
    return _index(spark, sf_dir, "index_stems", stop_words=(), stemmed=True)


@job(
    "txt_postings",
    f"""
    WITH {_INDEXED}
    SELECT doc_id, term, string_agg(CAST(pos AS STRING), ',' ORDER BY pos) AS positions FROM t GROUP BY doc_id, term
    """,
)
def txt_postings(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", "term", F.array_join("positions", ",").alias("positions"))


@job(
    "txt_boolean",
    """
    WITH <<tokens>>, d AS (
      SELECT doc_id, max(term = 'the') AS a, max(term = 'and') AS b, max(term = 'la') AS c, max(term = 'le') AS e,
             max(term = 'for') AS f FROM tokens GROUP BY doc_id)
    SELECT doc_id FROM d WHERE ((a AND b) OR (c AND NOT e)) AND NOT (f AND e)
    """,
)
def txt_boolean(spark, sf_dir):
    expr = And(
        (
            Or((And((Term("the"), Term("and"))), And((Term("la"), Not(Term("le")))))),
            Not(And((Term("for"), Term("le")))),
        )
    )
    return search.search(full_postings(spark, sf_dir), expr)


@job(
    "txt_not",
    """
    SELECT doc_id FROM documents
    WHERE NOT list_contains(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]{1,127}'), 'the')
    """,
)
def txt_not(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    return search.search(full_postings(spark, sf_dir), Not(Term("the")), documents)


@job(
    "txt_phrase",
    """
    WITH <<tokens>>
    SELECT DISTINCT x.doc_id FROM tokens x JOIN tokens y ON y.doc_id = x.doc_id AND y.pos = x.pos + 1
    JOIN tokens z ON z.doc_id = y.doc_id AND z.pos = y.pos + 1
    WHERE x.term IN ('and', 'by') AND y.term = 'the' AND z.term LIKE 'th%'
    """,
)
def txt_phrase(spark, sf_dir):
    phrase = Phrase((AnyOf((Term("and"), Term("by"))), Term("the"), Term("th*")))
    return search.search(full_postings(spark, sf_dir), phrase)


@job(
    "txt_distance_exact",
    """
    WITH <<tokens>>
    SELECT DISTINCT x.doc_id FROM tokens x JOIN tokens y ON y.doc_id = x.doc_id AND y.pos = x.pos + 3
    WHERE x.term = 'the' AND y.term = 'and'
    """,
)
def txt_distance_exact(spark, sf_dir):
    return search.search(full_postings(spark, sf_dir), Phrase((Term("the"), Term("and")), (3,)))


@job(
    "txt_near",
    """
    WITH <<tokens>>
    SELECT DISTINCT x.doc_id FROM tokens x JOIN tokens y ON y.doc_id = x.doc_id
     AND abs(y.pos - x.pos) BETWEEN 1 AND 4
    WHERE x.term = 'of' AND y.term = 'to'
    """,
)
def txt_near(spark, sf_dir):
    return search.search(full_postings(spark, sf_dir), Near(Term("of"), Term("to"), 4))


@job(
    "txt_wildcard",
    f"""
    WITH {_INDEXED}
    SELECT DISTINCT doc_id FROM t WHERE term LIKE 'ent%' OR term LIKE 'on%er'
    """,
)
def txt_wildcard(spark, sf_dir):
    return text_index(spark, sf_dir).search(Or((Term("ent*"), Term("on*er"))))


@job("txt_substring", "SELECT doc_id FROM documents WHERE strpos(text, 'tion th') > 0")
def txt_substring(spark, sf_dir):
    return text_index(spark, sf_dir).substring(fx.table(spark, sf_dir, "documents"), "doc_id", "text", "tion th").select("doc_id")


# Smallest ranges in which the tree holds, found from their starts.
@job(
    "txt_rank_covers",
    """
    WITH <<tokens>>, leaves AS (
      SELECT doc_id, 'a' AS leaf, pos AS s, pos AS e FROM tokens WHERE term IN ('of', 'der')
      UNION ALL SELECT doc_id, 'b', pos, pos FROM tokens WHERE term = 'ing'
      UNION ALL SELECT x.doc_id, 'c', x.pos, y.pos FROM tokens x JOIN tokens y ON y.doc_id = x.doc_id AND y.pos = x.pos + 1
                WHERE x.term = 'to' AND y.term = 'the'
      UNION ALL SELECT x.doc_id, 'd', least(x.pos, y.pos), greatest(x.pos, y.pos) FROM tokens x JOIN tokens y
                ON y.doc_id = x.doc_id AND abs(y.pos - x.pos) BETWEEN 1 AND 6 WHERE x.term = 'and' AND y.term = 'that'),
    reached AS (
      SELECT doc_id, s, min(e) FILTER (WHERE leaf = 'a') OVER w AS a, min(e) FILTER (WHERE leaf = 'b') OVER w AS b,
             min(e) FILTER (WHERE leaf = 'c') OVER w AS c, min(e) FILTER (WHERE leaf = 'd') OVER w AS d
      FROM leaves WINDOW w AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    ranges AS (
      SELECT doc_id, max(s) AS s, e FROM (
        SELECT doc_id, s, greatest(a, b, COALESCE(least(c, d), c, d)) AS e FROM reached
        WHERE a IS NOT NULL AND b IS NOT NULL AND (c IS NOT NULL OR d IS NOT NULL))
      GROUP BY doc_id, e)
    SELECT doc_id, count(*) AS n_covers, round(sum(1.0::DOUBLE / (e - s + 1)), 6) AS score FROM ranges
    GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 40
    """,
)
def txt_rank_covers(spark, sf_dir):
    either = Or((Phrase((Term("to"), Term("the"))), Near(Term("and"), Term("that"), 6)))
    tree = And((Or((Term("of"), Term("der"))), Term("ing"), either))
    return textindex.rank_covers(text_index(spark, sf_dir), tree, 40)


# An index of stale texts, one update of all of them in two parts, one removal; then merged.
@job(
    "txt_index_updates",
    """
    WITH <<tokens>>
    SELECT doc_id, term, string_agg(CAST(pos AS STRING), ',' ORDER BY pos) AS positions FROM tokens
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY doc_id, term
    """,
)
def txt_index_updates(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    index = textindex.TextIndex(spark, scratch_path(spark, "segments"), buckets=16, fan=8)
    stale = F.concat(F.lit("stale "), F.reverse("text"))
    index.add(widen(documents.withColumn("text", F.when(F.col("lang") == "en", F.col("text")).otherwise(stale))), "doc_id", "text")
    for lang in ("lang = 'de' OR lang = 'fr'", "lang NOT IN ('de', 'fr', 'en')"):
        index.add(widen(documents.where(lang)), "doc_id", "text")
    index.remove(fx.table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")
    index.merge()
    return index.postings().select("doc_id", "term", F.array_join("positions", ",").alias("positions"))


_SUFFIXES = {name: "|".join(sorted(table, key=lambda s: -len(s))) for name, table in (("2", stemming.STEP_2), ("3", stemming.STEP_3), ("4", stemming.STEP_4))}


def _map_sql(table):
    return "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in table.items()) + "}"


_V = "[aeiouy]"
_C = "[^aeiouy]"
_SHORT = f"(^{_V}{_C}|{_C}{_V}[^aeiouywxY])$"
# The published steps, one table expression each.
_SNOWBALL = f"""
    terms AS (SELECT DISTINCT term FROM tokens),
    marked AS (SELECT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '({_V})y', '\\1Y', 'g') AS w FROM terms WHERE length(term) > 2),
    first AS (SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
                WHEN regexp_matches(w, '{_V}{_C}') THEN length(regexp_extract(w, '^.*?{_V}{_C}')) ELSE length(w) END AS r1 FROM marked),
    regions AS (SELECT *, r1 + CASE WHEN regexp_matches(substr(w, r1 + 1), '{_V}{_C}')
                THEN length(regexp_extract(substr(w, r1 + 1), '^.*?{_V}{_C}')) ELSE length(w) - r1 END AS r2 FROM first),
    s1a AS (SELECT * REPLACE (CASE WHEN w LIKE '%sses' THEN left(w, -2)
                WHEN regexp_matches(w, 'ie[ds]$') THEN left(w, CASE WHEN length(w) > 4 THEN -2 ELSE -1 END)
                WHEN regexp_matches(w, '(us|ss)$') THEN w WHEN regexp_matches(w, '{_V}.+s$') THEN left(w, -1) ELSE w END AS w) FROM regions),
    p1b AS (SELECT *, w AS plain, regexp_extract(w, '(eedly|ingly|edly|eed|ing|ed)$') AS f FROM s1a),
    q1b AS (SELECT *, left(w, length(w) - length(f)) AS b FROM p1b),
    s1b AS (SELECT * REPLACE (CASE WHEN f = '' THEN w
                WHEN f LIKE 'eed%' THEN CASE WHEN length(b) >= r1 THEN concat(b, 'ee') ELSE w END
                WHEN NOT regexp_matches(b, '{_V}') THEN w WHEN regexp_matches(b, '(at|bl|iz)$') THEN concat(b, 'e')
                WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(b, -1)
                WHEN length(b) <= r1 AND regexp_matches(b, '{_SHORT}') THEN concat(b, 'e') ELSE b END AS w) FROM q1b),
    s1c AS (SELECT * REPLACE (regexp_replace(w, '^(.+{_C})[yY]$', '\\1i') AS w) FROM s1b),
    p2 AS (SELECT * REPLACE (regexp_extract(w, '({_SUFFIXES["2"]})$') AS f) FROM s1c),
    q2 AS (SELECT * REPLACE (left(w, length(w) - length(f)) AS b) FROM p2),
    s2 AS (SELECT * REPLACE (CASE WHEN f <> '' AND length(b) >= r1 AND (f <> 'ogi' OR b LIKE '%l')
                AND (f <> 'li' OR regexp_matches(b, '[{stemming.BEFORE_LI}]$')) THEN concat(b, {_map_sql(stemming.STEP_2)}[f]) ELSE w END AS w) FROM q2),
    p3 AS (SELECT * REPLACE (regexp_extract(w, '({_SUFFIXES["3"]})$') AS f) FROM s2),
    q3 AS (SELECT * REPLACE (left(w, length(w) - length(f)) AS b) FROM p3),
    s3 AS (SELECT * REPLACE (CASE WHEN f <> '' AND length(b) >= r1 AND (f <> 'ative' OR length(b) >= r2)
                THEN concat(b, {_map_sql(stemming.STEP_3)}[f]) ELSE w END AS w) FROM q3),
    p4 AS (SELECT * REPLACE (regexp_extract(w, '({_SUFFIXES["4"]})$') AS f) FROM s3),
    q4 AS (SELECT * REPLACE (left(w, length(w) - length(f)) AS b) FROM p4),
    s4 AS (SELECT * REPLACE (CASE WHEN f <> '' AND length(b) >= r2 AND (f <> 'ion' OR regexp_matches(b, '[st]$')) THEN b ELSE w END AS w) FROM q4),
    s5 AS (SELECT * REPLACE (CASE WHEN (w LIKE '%e' AND (length(w) > r2 OR (length(w) > r1 AND NOT regexp_matches(left(w, -1), '{_SHORT}'))))
                OR (w LIKE '%ll' AND length(w) > r2) THEN left(w, -1) ELSE w END AS w) FROM s4),
    stems AS (SELECT term, CASE WHEN {_map_sql(stemming.WHOLE_WORDS)}[term] IS NOT NULL THEN {_map_sql(stemming.WHOLE_WORDS)}[term]
                WHEN plain IN ({", ".join(f"'{w}'" for w in stemming.KEPT_AFTER_PLURALS)}) THEN plain ELSE replace(w, 'Y', 'y') END AS stem FROM s5
              UNION ALL SELECT term, term FROM terms WHERE length(term) <= 2)"""


@job(
    "txt_dictionary",
    f"""
    WITH <<tokens>>, {_SNOWBALL},
    counted AS (SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS total_freq FROM tokens GROUP BY term)
    SELECT term, stem, doc_freq, total_freq FROM counted JOIN stems USING (term)
    """,
)
def txt_dictionary(spark, sf_dir):
    return text_index(spark, sf_dir).dictionary().select("term", "stem", "doc_freq", "total_freq")


@job(
    "txt_snowball",
    f"""
    WITH <<tokens>>, {_SNOWBALL}
    SELECT DISTINCT doc_id FROM tokens JOIN stems USING (term)
    WHERE stem IN (SELECT stem FROM stems WHERE term IN ('oning', 'hation')) AND doc_id IN (SELECT doc_id FROM tokens WHERE term = 'of')
    """,
)
def txt_snowball(spark, sf_dir):
    either = Or((Term("oning", stemmed=True), Term("hation", stemmed=True)))
    return text_index(spark, sf_dir).search(And((either, Term("of"))))


@job(
    "txt_rank_topk",
    """
    WITH <<tokens>>
    SELECT x.doc_id, round(sum(1.0 / abs(y.pos - x.pos)), 6) AS score
    FROM tokens x JOIN tokens y ON y.doc_id = x.doc_id AND abs(y.pos - x.pos) BETWEEN 1 AND 5
    WHERE x.term = 'the' AND y.term = 'and' GROUP BY x.doc_id ORDER BY score DESC, x.doc_id LIMIT 10
    """,
)
def txt_rank_topk(spark, sf_dir):
    return search.rank_near(full_postings(spark, sf_dir), Term("the"), Term("and"), 5, 10)


@job(
    "txt_highlight",
    r"""
    WITH <<tokens>>, hits AS (SELECT DISTINCT doc_id FROM tokens WHERE term = 'the'),
    once AS (SELECT doc_id, regexp_replace(text, '(?i)(^|[^\p{L}\p{N}_])(the|and)($|[^\p{L}\p{N}_])',
                                           concat('\1', chr(1), '\2', chr(2), '\3'), 'g') AS t
             FROM documents JOIN hits USING (doc_id)),
    twice AS (SELECT doc_id, regexp_replace(t, '(?i)(^|[^\p{L}\p{N}_\x01\x02]|\x02)(the|and)($|[^\p{L}\p{N}_\x01\x02]|\x01)',
                                            concat('\1', chr(1), '\2', chr(2), '\3'), 'g') AS t FROM once)
    SELECT doc_id, replace(replace(t, chr(1), '<b>'), chr(2), '</b>') AS marked FROM twice
    """,
)
def txt_highlight(spark, sf_dir):
    hits = search.search(full_postings(spark, sf_dir), Term("the"))
    marked = highlight(F.col("text"), ["the", "and"]).alias("marked")
    return fx.table(spark, sf_dir, "documents").join(hits, "doc_id", "left_semi").select("doc_id", marked)


@job(
    "txt_hits_per_year",
    """
    WITH <<works>>, <<tokens>>, hits AS (SELECT DISTINCT doc_id FROM tokens WHERE term = 'the'),
    years AS (SELECT unnest(range(1990, 2031)) AS year),
    n AS (SELECT publication_year AS year, count(*) AS n FROM works JOIN hits USING (doc_id) GROUP BY 1)
    SELECT CAST(y.year AS INT) AS year, COALESCE(n.n, 0) AS n_hits FROM years y LEFT JOIN n USING (year)
    """,
)
def txt_hits_per_year(spark, sf_dir):
    hits = search.search(full_postings(spark, sf_dir), Term("the"))
    works = fx.works(spark, sf_dir).join(hits, "doc_id", "left_semi")
    return reports.per_year(spark, works, 1990, 2030, {"n_hits": F.count(F.lit(1))})


@job(
    "txt_term_stats",
    f"""
    WITH {_INDEXED}
    SELECT term, count(DISTINCT doc_id) AS doc_freq, count(*) AS total_freq FROM t GROUP BY term
    """,
)
def txt_term_stats(spark, sf_dir):
    return search.term_statistics(postings(spark, sf_dir))


@job(
    "set_union_hits",
    """
    WITH <<works>>, <<tokens>>, title_hits AS (
      SELECT doc_id FROM works WHERE list_contains(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]{1,127}'), 'by'))
    SELECT doc_id FROM title_hits
    UNION
    SELECT doc_id FROM tokens JOIN works USING (doc_id) WHERE term = 'ent' AND abstract IS NOT NULL
    """,
)
def set_union_hits(spark, sf_dir):
    works = fx.works(spark, sf_dir)
    parts = {}
    for column, word in (("title", "by"), ("abstract", "ent")):
        built = search.build_postings(works, "doc_id", column, stop_words=())
        index = stored(spark, sf_dir, f"index_{column}", lambda path, built=built: search.write_index(built, path))
        parts[column] = search.search(index, Term(word))
    return parts["title"].union(parts["abstract"]).distinct()


_STEM = """regexp_replace(regexp_replace(regexp_replace({t}, 'sses$', 'ss'), 'ies$', 'i'), '([^s])s$', '\\1')"""


@job(
    "txt_stemmed",
    f"""
    WITH <<tokens>>, plain AS (SELECT doc_id, {_STEM.format(t="term")} AS stem FROM tokens),
    bare AS (SELECT doc_id, stem, regexp_replace(stem, '([aeiouy].*)(ing|ed)$', '\\1') AS b FROM plain),
    cut AS (SELECT doc_id, CASE WHEN b <> stem AND right(b, 2) IN ('bb','dd','ff','gg','mm','nn','pp','rr','tt')
                                THEN left(b, length(b) - 1) ELSE b END AS s FROM bare)
    SELECT DISTINCT doc_id FROM cut WHERE s IN ('ention', 'onat')
    """,
)
def txt_stemmed(spark, sf_dir):
    return search.search(stems(spark, sf_dir), Or((Term("entions", stemmed=True), Term("onating", stemmed=True))))


@job(
    "flt_missing_in_range",
    """
    WITH <<index>>
    SELECT id, doi FROM idx
    WHERE abstract IS NULL AND (created_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
                                OR updated_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20')
    """,
)
def flt_missing_in_range(spark, sf_dir):
    return search.missing_in_range(fx.index(spark, sf_dir), "2024-01-10", "2024-01-20").select("id", "doi")
