"""Queries of the training-data operators over the given tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    divergence, embeddings, licences, linededup, minhash, mixing, packing, phrases, quality,
    rollups, simhash, substrings, urlfilter,
)
from .common import load, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; without an oracle it is held against brute force in tests/llm."""

    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


_TEMPLATES_SQL = ", ".join(
    f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licences.TEMPLATES))

OP1_SQL = rf"""
WITH template(i, name, text) AS (VALUES {_TEMPLATES_SQL}),
term AS (
  SELECT i, tok, count(*) AS c
  FROM (SELECT i, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS tok FROM template) GROUP BY ALL
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
         concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), doc_id // 1000,
                   doc_id // 10, doc_id) AS path
  FROM documents
), line AS (
  SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS no FROM docs
), in_line AS (
  SELECT rid, no, tok, count(*) AS c
  FROM (SELECT rid, no, unnest(regexp_extract_all(lower(line), '[a-z0-9]+')) AS tok FROM line) GROUP BY ALL
), in_doc AS (
  SELECT rid, tok, sum(c) AS c FROM in_line GROUP BY ALL
), total AS (
  SELECT count(*) AS n FROM docs
), idf AS (
  SELECT v.tok, ln((1 + any_value(n)) / (1 + count(d.rid))) + 1 AS w
  FROM (SELECT DISTINCT tok FROM term) v CROSS JOIN total LEFT JOIN in_doc d USING (tok) GROUP BY v.tok
), template_weight AS (
  SELECT i, tok, c * w / sqrt(sum(c * c * w * w) OVER (PARTITION BY i)) AS x FROM term JOIN idf USING (tok)
), unit AS (
  SELECT rid, no, tok, c FROM in_line UNION ALL SELECT rid, -1, tok, c FROM in_doc
), weighed AS (
  SELECT rid, no, tok, c * coalesce(w, ln(1 + n) + 1) AS x FROM unit CROSS JOIN total LEFT JOIN idf USING (tok)
), length AS (
  SELECT rid, no, sqrt(sum(x * x)) AS len FROM weighed GROUP BY ALL
), score AS (
  SELECT u.rid, u.no, t.i, sum(u.x * t.x) / any_value(len) AS s
  FROM weighed u JOIN template_weight t USING (tok) JOIN length l ON l.rid = u.rid AND l.no = u.no GROUP BY ALL
), own AS (
  SELECT rid, no, name, s FROM score JOIN template USING (i) WHERE s >= 0.8
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY no >= 0, round(s, 9) DESC, i, no) = 1
), file AS (
  SELECT d.rid, doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, name AS licence, s,
         CASE WHEN no = -1 THEN 'file' WHEN no >= 0 THEN 'header' END AS kind,
         CASE WHEN no >= 0 THEN no END AS line
  FROM docs d LEFT JOIN own USING (rid)
), declared AS (
  SELECT dir, coalesce(
           (SELECT f.licence FROM file f WHERE f.dir = g.dir AND f.kind = 'file'
            GROUP BY f.licence ORDER BY count(*) DESC, f.licence LIMIT 1),
           CASE WHEN count(DISTINCT licence) FILTER (WHERE kind = 'header') = 1
                THEN min(licence) FILTER (WHERE kind = 'header') END) AS licence
  FROM file g WHERE licence IS NOT NULL GROUP BY dir
), ancestor AS (
  SELECT dir, array_to_string(list_slice(string_split(dir, '/'), 1, depth), '/') AS up, depth
  FROM (SELECT dir, unnest(generate_series(0, len(string_split(dir, '/')))) AS depth
        FROM (SELECT DISTINCT dir FROM file))
), near AS (
  SELECT a.dir, a.up, d.licence FROM ancestor a JOIN declared d ON d.dir = a.up WHERE d.licence IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a.dir ORDER BY a.depth DESC) = 1
)
SELECT doc_id, path, coalesce(f.licence, n.licence) AS licence,
       coalesce(kind, CASE WHEN n.licence IS NOT NULL THEN 'inherited' END) AS origin,
       CASE WHEN f.licence IS NULL THEN n.up END AS directory, CAST(line AS BIGINT) AS line,
       round(s, 6) AS score
FROM file f LEFT JOIN near n ON n.dir = f.dir
"""


@query("op1_licences", OP1_SQL)
def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, laid out as source/language/thousands/tens/id."""
    docs = load(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                       F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 10), "doc_id")
    rows = licences.scan(docs, path, keep=["doc_id"])
    return rows.select("item.doc_id", "path", "licence", "origin", "directory", "line",
                       F.round("score", 6).alias("score"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    rows = simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=3, radius=3,
                                   keep=["doc_id"])
    return rows.select("doc.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    rows = quality.judge(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "distance")


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), words AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs
), windows AS (
  SELECT rid, pos, word, md5(string_agg(word, ' ') OVER f) AS seq, count(*) OVER f AS n
  FROM words WINDOW f AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), repeated AS (
  SELECT seq FROM windows WHERE n = 35 GROUP BY seq HAVING count(*) > 1
), covered AS (
  SELECT rid, pos, word, max(CASE WHEN n = 35 AND seq IN (SELECT seq FROM repeated) THEN 1 ELSE 0 END)
         OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM windows
), rest AS (
  SELECT rid, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept
  FROM covered GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN rest USING (rid)
"""


@query("op4_substrings", OP4_SQL)
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document after repeated passages of 35 words went."""
    rows = substrings.remove_repeats(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("doc.doc_id", "n_words", "n_removed", "kept_sha256")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    rows = mixing.mix(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("doc.doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_fuzzy_lines")
def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left in every document."""
    rows = linededup.deduplicate(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select("doc.doc_id", "n_lines", "n_removed",
                       F.sha2("text", 256).alias("kept_sha256"))


#: The fixed site rules and the word rules of the method, in order.
URL_RULES = [
    urlfilter.site_rule("org/", "allow"),
    urlfilter.site_rule("example.org/es/", "block"),
    urlfilter.site_rule("example.org/en/1", "block"),
    urlfilter.site_rule("com/fr/", "allow"),
    urlfilter.site_rule("com/de/", "block"),
    *(urlfilter.word_rule(w, "block") for w in (
        "cheap-pills", "free-bets", "casino", "poker", "xxx", "adult-cams", "payday-loans")),
]

_SITE_SQL = " ".join(
    f"UNION ALL SELECT '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}'"
    for r, v in (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
                 ("com/fr/", "allow"), ("com/de/", "block"))).removeprefix("UNION ALL ")

OP7_SQL = f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         row_number() OVER () AS rid
  FROM pages
), site(rule, rule_host, rule_path, said) AS ({_SITE_SQL}),
fit AS (
  SELECT rid, max_by(rule, length(rule)) AS rule, max_by(said, length(rule)) AS said
  FROM parts JOIN site ON (host = rule_host OR ends_with(host, '.' || rule_host))
                      AND starts_with(path, rule_path)
  GROUP BY rid
)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN regexp_matches(host || path,
         '(?i)(^|[^a-z0-9])(cheap-pills|free-bets|casino|poker|xxx|adult-cams|payday-loans)([^a-z0-9]|$)')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fit USING (rid)
"""


@query("op7_url_rules", OP7_SQL)
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, URL_RULES).select(
        "page.page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
WITH counted AS (
  SELECT source, lang,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
         list_distinct(string_split(coalesce(text, ''), chr(10))) AS lines
  FROM documents
), kept AS (
  SELECT source, lang, array_to_string(lines, chr(10)) AS once FROM counted WHERE n >= 10
), counts AS (
  SELECT source, lang, 'words.v1' AS tokenizer,
         len(regexp_extract_all(once, '[^\x20\x09-\x0D]+')) AS tokens FROM kept
  UNION ALL
  SELECT source, lang, 'words.v2',
         len(regexp_extract_all(once, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counts GROUP BY ALL
"""


@query("op8_token_rollup", OP8_SQL)
def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a history of batches over all documents: all come in under the first
    tokenizer, those of under ten words go, those that repeat a line are revised to their
    distinct lines, the second tokenizer is added, and the deletes are sent once more."""
    v1, v2 = {"words.v1": "n words.v1"}, {"words.v2": "u words.v2"}
    u1 = {"words.v1": "u words.v1"}
    docs = written(rollups.counted(load(spark, sf_dir, "documents")), "counted")
    short = rollups.deletes(docs.where("`n words.v1` < 10"), v1)
    left = docs.where("`n words.v1` >= 10")
    rollup = rollups.Rollup(spark)
    rollup.commit("1", rollups.inserts(docs, v1))
    rollup.commit("2", short)
    rollup.commit("3", rollups.revisions(left.where("`n words.v1` <> `u words.v1`"), v1, u1))
    rollup.commit("4", rollups.inserts(left, v2))
    rollup.commit("2", short)
    return rollup.totals()


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), links AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a
), lowest AS (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN links USING (vec_id) LEFT JOIN lowest USING (vec_id)
"""


@query("op9_embeddings", OP9_SQL)
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors."""
    rows = embeddings.near_duplicates(load(spark, sf_dir, "embeddings"), threshold=0.93,
                                      keep=["vec_id"])
    return rows.select("row.vec_id", "n_links", "component_id", "kept")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op11_fingerprints")
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, their likeness to each other and to
    the next document, and the document's near-duplicate group."""
    docs = load(spark, sf_dir, "documents")
    rows = minhash.grouped(minhash.followed(docs, shingle=5, keep=["doc_id"]), minhash.digests(docs),
                           threshold=0.8, shingle=5)
    return rows.select("doc.doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
                       F.lower(F.hex("print")).alias("fingerprint"),
                       F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
                       "near_edited", "near_next", "component_id")


OP12_SQL = rf"""
WITH piece AS (
  SELECT lang, rid, unnest(p) AS piece, generate_subscripts(p, 1) AS part
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS rid,
               string_split_regex(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'),
                                  '[.,;:!?\x0A-\x0D]') AS p FROM documents)
), word AS (
  SELECT lang, rid, part, unnest(w) AS w1, generate_subscripts(w, 1) AS pos
  FROM (SELECT lang, rid, part, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece)
), near AS (
  SELECT lang, w1, lead(w1) OVER x AS w2, lead(w1, 2) OVER x AS w3
  FROM word WINDOW x AS (PARTITION BY rid, part ORDER BY pos)
), total AS (
  SELECT lang, count(*) AS n FROM near GROUP BY lang
), one AS (
  SELECT lang, w1, count(*)::HUGEINT AS f FROM near GROUP BY ALL
), two AS (
  SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM near WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), three AS (
  SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM near WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cut AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r,
         t.w1, t.w2, NULL AS w3
  FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f, t.w1, t.w2, t.w3
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
               JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f, t.w1, t.w2, t.w3
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
               JOIN one y ON y.lang = t.lang AND y.w1 = t.w3
), scored AS (
  SELECT *, 1000000 * a * a // (l * r) AS score FROM cut
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY 1000000 * a * a // (l * r), k) = 1
), longer AS (
  SELECT lang, x, y, max(f) AS f
  FROM (SELECT lang, w1 AS x, w2 AS y, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer g ON s.w3 IS NULL AND g.lang = s.lang AND g.x = s.w1 AND g.y = s.w2
  WHERE g.f IS NULL OR 100 * g.f < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""


@query("op12_phrases", OP12_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two or three words of every language."""
    return phrases.collocations(load(spark, sf_dir, "documents"), order=3, min_count=10, share=50,
                                top=2000)


OP13_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS text
  FROM documents
), found AS (
  SELECT rid, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM doc
), kept AS (
  SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT rid) >= 30
), size AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), occurs AS (
  SELECT lang, source, term, count(*) AS c FROM found JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
  SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM doc)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM occurs GROUP BY ALL) USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (n + 5 * v) AS p
  FROM grp g JOIN kept k ON k.lang = g.lang JOIN size s ON s.lang = g.lang
  LEFT JOIN occurs o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang)
         + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM occurs GROUP BY ALL)
), apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), part AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0) AS f
  FROM grp x JOIN grp y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS INTEGER) AS rank
FROM part
QUALIFY part = 'pair' OR rank <= 50
"""


@query("op13_divergence", OP13_SQL)
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's distances from the others of its language, and its most typical terms."""
    return divergence.divergence(load(spark, sf_dir, "documents"), min_docs=30, top_terms=50)
