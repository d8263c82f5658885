"""Registered queries on texts, pages and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.operators import cleaning
from fathomline.operators.encoding import ENCODERS, encoded
from fathomline.operators.filters import Filters, filtered
from fathomline.plans.registered import query
from fathomline.sources import corpus
from fathomline.sources import queries as query_source

CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


@query(f"SELECT doc_id, length(regexp_replace(text, '{CONTROLS}', '', 'g')) AS n, sha256(regexp_replace(text, '{CONTROLS}', '', 'g')) AS sha FROM documents")
def strip_controls(table, spark):
    t = text.strip_controls(F.col("text"))
    return table("documents").select("doc_id", F.length(t).cast("long").alias("n"), text.text_hash(t).alias("sha"))


@query(r"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), ' +\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS t FROM documents) SELECT doc_id, length(t) AS n, sha256(t) AS sha FROM c""")
def clean_whitespace(table, spark):
    t = text.collapse_blanks(F.col("text"))
    return table("documents").select("doc_id", F.length(t).cast("long").alias("n"), text.text_hash(t).alias("sha"))


@query("SELECT sha256(text) AS hash_texto, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def text_hash_dedup(table, spark):
    return table("documents").groupBy(text.text_hash(F.col("text")).alias("hash_texto")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS key_sha FROM documents")
def normalize_entity_id(table, spark):
    return table("documents").select("doc_id", text.text_hash(text.entity_key(F.col("text"))).alias("key_sha"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(lower(source || '-' || lang || ' ' || doc_id), '[^a-z0-9áéíóúñü]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM documents")
def slugify(table, spark):
    return table("documents").select("doc_id", text.slug(F.concat("source", F.lit("-"), "lang", F.lit(" "), "doc_id")).alias("slug"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS num_tokens FROM documents")
def token_counts(table, spark):
    return table("documents").select("doc_id", text.word_count(F.col("text")).cast("long").alias("num_tokens"))


@query(r"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, i AS piece, CASE WHEN len(w) <= 512 THEN text ELSE array_to_string(w[i * 512 + 1:i * 512 + 512], ' ') END AS t FROM (SELECT *, unnest(range(0, greatest(1, (len(w) + 511) // 512))) AS i FROM w))
SELECT doc_id, piece, sha256(t) AS sha FROM p""")
def hard_split(table, spark):
    return table("documents").select("doc_id", F.posexplode(text.hard_split(F.col("text"), 512)).alias("piece", "t")).select("doc_id", F.col("piece").cast("long").alias("piece"), text.text_hash(F.col("t")).alias("sha"))


@query(r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM documents)
SELECT doc_id, count(*) AS n, sum(length(trim(s)))::BIGINT AS chars FROM s WHERE trim(s) <> '' GROUP BY doc_id""")
def sentence_split(table, spark):
    s = table("documents").select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"))


@query(r"""WITH p AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS n, unnest(l) AS p FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS l FROM documents))
SELECT doc_id, n, sha256(p) AS sha FROM p""")
def paragraph_split(table, spark):
    p = text.paragraphs(F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")))
    return table("documents").select("doc_id", F.posexplode(p).alias("n", "p")).select("doc_id", F.col("n").cast("long").alias("n"), text.text_hash(F.col("p")).alias("sha"))


CANDIDATE = r"length(line) > 0 AND length(line) <= 80 AND NOT regexp_matches(line, '^[0-9_\W]+$') AND NOT regexp_matches(line, '^[^:\n]{1,30}: ')"


def _sections(table):
    """Turns of conversations as sections of a document."""
    return table("conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("orden"), F.col("text").alias("texto"))


@query(f"""WITH l AS (SELECT conv_id AS doc_id, turn, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM conversations)
SELECT doc_id, line, count(DISTINCT turn) AS n_sections FROM l WHERE {CANDIDATE} GROUP BY doc_id, line HAVING count(DISTINCT turn) >= 2""")
def boilerplate_local(table, spark):
    return cleaning.local_boilerplate(_sections(table))


BOILERPLATE = f"""WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents),
b AS (SELECT line, count(DISTINCT doc_id) AS n_docs FROM l WHERE {CANDIDATE} GROUP BY line HAVING count(DISTINCT doc_id) >= 3)"""


@query(f"{BOILERPLATE} SELECT line, n_docs FROM b")
def boilerplate_corpus(table, spark):
    return cleaning.corpus_boilerplate(table("documents").select("doc_id", F.col("text").alias("texto")))


@query(f"""{BOILERPLATE}, x AS (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept FROM x WHERE trim(line, ' ') NOT IN (SELECT line FROM b) GROUP BY doc_id)
SELECT d.doc_id, sha256(coalesce(kept, '')) AS sha FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id""")
def remove_boilerplate(table, spark):
    docs = table("documents").select("doc_id", F.col("text").alias("texto"))
    return cleaning.without_boilerplate(docs, cleaning.corpus_boilerplate(docs)).select("doc_id", text.text_hash(F.col("texto")).alias("sha"))


def guess_sql(source: str) -> str:
    """A table guess(doc_id, idioma) of source(doc_id, text), as the end of a WITH clause."""
    hits = ", ".join("len(list_filter(w, lambda x: list_contains([" + ", ".join(f"'{x}'" for x in ws) + f"], x))) AS {lang}" for lang, ws in sorted(cleaning.STOP_WORDS.items()))
    best = " ".join(f"WHEN {a} = greatest(de, en, es, fr) THEN '{a}'" for a in sorted(cleaning.STOP_WORDS))
    return rf"guess_words AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w FROM {source}), guess_hits AS (SELECT doc_id, text, {hits} FROM guess_words), guess AS (SELECT doc_id, CASE WHEN length(text) < 50 OR greatest(de, en, es, fr) = 0 THEN 'es' {best} END AS idioma FROM guess_hits)"


@query(f"WITH {guess_sql('documents')} SELECT * FROM guess")
def language_guess(table, spark):
    return table("documents").select("doc_id", cleaning.language_guess(F.col("text")).alias("idioma"))


def _fragments(table):
    d = table("documents")
    return d.select("doc_id", (1 + F.col("doc_id") % 3).cast("int").alias("fenomeno"), F.col("source").alias("formato"), F.when(F.col("doc_id") % 7 > 0, F.upper("lang")).alias("idioma"), (F.col("n_chars") / 1000.0).alias("cosine_score"))


@query("SELECT doc_id FROM documents WHERE 1 + doc_id % 3 = 2 AND source = 'src3' AND n_chars / 1000.0 >= 0")
def metadata_filter(table, spark):
    return filtered(_fragments(table), Filters(topic=2, format="src3")).select("doc_id")


@query("SELECT doc_id FROM documents WHERE (doc_id % 7 = 0 OR lower(lang) = 'es') AND n_chars / 1000.0 >= 0")
def lang_filter_null_safe(table, spark):
    return filtered(_fragments(table), Filters(language="ES")).select("doc_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0 OR (o_orderdate >= DATE '1995-01-01' AND o_orderdate <= DATE '1996-06-30')")
def date_range_filter(table, spark):
    """Dates come in three spellings; a fifth of the rows has none and passes."""
    d = F.col("o_orderdate").cast("date")
    spelled = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).when(F.col("o_orderkey") % 5 == 1, F.date_format(d, "dd/MM/yyyy")).when(F.col("o_orderkey") % 5 == 2, F.date_format(d, "yyyy/MM/dd")).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00Z")))
    rows = table("orders").select("o_orderkey", spelled.alias("fecha_publicacion"), F.lit(1.0).alias("cosine_score"))
    return filtered(rows, Filters(dates=("1995-01-01", "1996-06-30"))).select("o_orderkey")


@query(r"""WITH p AS (SELECT page_id, list_reverse(string_split(lower(url), '/')) AS p FROM pages)
SELECT page_id, coalesce(CASE list_filter(p[2:], lambda x: list_contains(['fr', 'en', 'de'], x))[1] WHEN 'fr' THEN 2 WHEN 'en' THEN 1 WHEN 'de' THEN 3 END, CASE WHEN contains(regexp_replace(p[1], '\.[^.]*$', ''), 'fr') THEN 2 WHEN contains(regexp_replace(p[1], '\.[^.]*$', ''), 'en') THEN 1 WHEN contains(regexp_replace(p[1], '\.[^.]*$', ''), 'de') THEN 3 END, 9)::INT AS fenomeno FROM p""")
def topic_assignment(table, spark):
    return table("pages").select("page_id", corpus.topic(F.col("url"), {"fr": 2, "en": 1, "de": 3}, 9).alias("fenomeno"))


_HTML = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script\b.*?</script\s*>', ' ', 'gis'), '<style\b.*?</style\s*>', ' ', 'gis'), '<!--.*?-->', ' ', 'gs'), '<[^>]+>', ' ', 'g')"
for _e, _c in (("&nbsp;", "' '"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
    _HTML = f"replace({_HTML}, '{_e}', {_c})"


@query(rf"SELECT page_id, length(trim(regexp_replace({_HTML}, '\s+', ' ', 'g'))) AS n, sha256(trim(regexp_replace({_HTML}, '\s+', ' ', 'g'))) AS sha FROM pages")
def html_to_text(table, spark):
    t = text.html_text(F.col("html"))
    return table("pages").select("page_id", F.length(t).cast("long").alias("n"), text.text_hash(t).alias("sha"))


@query(r"SELECT page_id, regexp_extract(html, '<html[^>]*\blang=\"([^\"]*)\"', 1) AS idioma, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS titulo FROM pages")
def html_title_lang(table, spark):
    return table("pages").select("page_id", F.regexp_extract("html", r'<html[^>]*\blang="([^"]*)"', 1).alias("idioma"), F.trim(F.regexp_extract("html", r"<title>([^<]*)</title>", 1)).alias("titulo"))


_BLOCK_TEXT = r"regexp_replace(regexp_replace({x}, '^<[^>]*>', ''), '<[^>]*>', '', 'g')"
for _e, _c in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
    _BLOCK_TEXT = f"replace({_BLOCK_TEXT}, '{_e}', {_c})"


# A page is cut before each tag that opens or closes a block or a section; what follows an opening one is its text.
@query(rf"""WITH x AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->', '', 'g'), '(?i)(</?(?:title|h[1-6]|li|p|article|section)\b[^>]*>)', chr(1) || '\1', 'g'), chr(1)) AS s FROM pages),
k AS (SELECT page_id, i, lower(regexp_extract(x, '^<(/?[a-zA-Z0-9]+)', 1)) AS tag, trim(regexp_replace({_BLOCK_TEXT.format(x='x')}, '\s+', ' ', 'g')) AS t FROM (SELECT page_id, generate_subscripts(s, 1) AS i, unnest(s) AS x FROM x)),
g AS (SELECT *, sum((tag IN ('article', '/article', 'section', '/section') OR regexp_matches(tag, '^h[1-6]$') AND t <> '')::INT) OVER (PARTITION BY page_id ORDER BY i) AS sec FROM k),
s AS (SELECT page_id, sec, max(CASE WHEN regexp_matches(tag, '^h[1-6]$') AND t <> '' THEN t END) AS seccion, string_agg(CASE WHEN tag IN ('p', 'li') AND t <> '' THEN t END, chr(10) || chr(10) ORDER BY i) AS texto FROM g GROUP BY page_id, sec),
o AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY sec) - 1 AS orden FROM s WHERE texto IS NOT NULL),
h AS (SELECT page_id, min_by(t, i) FILTER (WHERE tag = 'title' AND t <> '') AS titulo FROM k GROUP BY page_id)
SELECT h.page_id::VARCHAR AS path, titulo, nullif(regexp_extract(html, '<html[^>]*\blang="([^"]*)"', 1), '') AS idioma, orden, seccion, sha256(texto) AS sha FROM pages p JOIN h ON h.page_id = p.page_id LEFT JOIN o ON o.page_id = p.page_id""")
def html_sections(table, spark):
    """Sections by the HTML extractor."""
    files = table("pages").select(F.col("page_id").cast("string").alias("path"), F.encode("html", "UTF-8").alias("content"), F.lit("html").alias("ext"))
    return corpus.extract(files).select("path", "titulo", "idioma", F.posexplode_outer("secciones").alias("orden", "s")).select("path", "titulo", "idioma", F.col("orden").cast("long").alias("orden"), F.col("s.titulo").alias("seccion"), text.text_hash(F.col("s.texto")).alias("sha"))


@query(r"SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, len(json_keys(props)) AS n_keys FROM events")
def extract_json_props(table, spark):
    m = F.from_json("props", "map<string,string>")
    return table("events").select("event_id", F.get(F.map_values(m), 0).alias("first_value"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


_STOP = r"CASE WHEN {x} = '' OR regexp_matches({x}, '[.!?:»›]$') THEN {x} ELSE {x} || '.' END"


@query(rf"""WITH t AS (SELECT item_id, trim(replace(text, '.', ';'), ' ') AS t FROM benchmark)
SELECT item_id, sha256(CASE WHEN len(t) - len(replace(t, ';', '')) >= 2 AND NOT regexp_matches(t, '[.!?:»›]$') THEN array_to_string(list_transform(list_filter(list_transform(string_split(t, ';'), lambda x: trim(x, ' ')), lambda x: x <> ''), lambda x: {_STOP.format(x='x')}), ' ') ELSE {_STOP.format(x='t')} END) AS sha FROM t""")
def normalize_paragraph(table, spark):
    t = text.normalised_paragraph(F.replace(F.col("text"), F.lit("."), F.lit(";")))
    return table("benchmark").select("item_id", text.text_hash(t).alias("sha"))


@query("SELECT 'q' || printf('%03d', i) AS query_id, 'missing' AS problem FROM range(1, 51) t(i) WHERE i NOT IN (SELECT item_id FROM benchmark) UNION ALL SELECT 'q' || printf('%03d', item_id), 'unexpected' FROM benchmark WHERE item_id < 1 OR item_id > 50")
def query_integrity(table, spark):
    return query_source.integrity(table("benchmark").select(F.format_string("q%03d", "item_id").alias("query_id")))


TERMS = r"list_distinct(list_filter(regexp_extract_all(lower(text), '\p{L}{4,}'), lambda x: NOT list_contains(['that', 'with', 'this', 'from'], x)))"


@query(rf"""WITH q AS (SELECT item_id, unnest({TERMS}) AS term FROM benchmark), d AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
n AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id), j AS (SELECT item_id, doc_id, count(*) AS shared FROM q JOIN d USING (term) GROUP BY item_id, doc_id)
SELECT item_id, doc_id, shared, CASE WHEN shared >= 0.5 * n THEN 'on topic' WHEN shared >= 0.2 * n THEN 'partial' ELSE 'weak' END AS verdict FROM j JOIN n USING (item_id) WHERE shared >= 0.2 * n""")
def term_overlap_audit(table, spark):
    """Documents that share a fifth of a query's terms of four letters or more, without stop words."""
    words = lambda c: F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}{4,}"), F.lit(0)), lambda x: ~x.isin("that", "with", "this", "from")))
    q = table("benchmark").select("item_id", F.explode(words("text")).alias("term"))
    d = table("documents").select("doc_id", F.explode(words("text")).alias("term"))
    n = q.groupBy("item_id").agg(F.count("*").alias("n"))
    j = q.join(d, "term").groupBy("item_id", "doc_id").agg(F.count("*").alias("shared")).join(n, "item_id").filter(F.col("shared") >= 0.2 * F.col("n"))
    return j.select("item_id", "doc_id", "shared", F.when(F.col("shared") >= 0.5 * F.col("n"), "on topic").otherwise("partial").alias("verdict"))


@query()
def encode_documents(table, spark):
    """The built-in encoder: dimension and norm of each text's vector; of longer texts the sentences that fit into 512 words count."""
    from fathomline.operators.search import dot

    out = encoded(table("documents").select("doc_id", F.col("text").alias("texto")), ENCODERS.create("hashed-128"))
    return out.select("doc_id", F.size("vector").alias("dim"), F.round(dot(F.col("vector"), F.col("vector")), 4).alias("norm"))


@query(r"SELECT doc_id, sha256(CASE WHEN len(w) <= 20 THEN text ELSE array_to_string(w[1:20], ' ') END) AS sha FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM documents)")
def truncate_words(table, spark):
    """A truncating operator: the first 20 words."""
    return table("documents").select("doc_id", text.text_hash(text.truncated(F.col("text"), 20)).alias("sha"))


CATALOGUE = (
    ("bert-en", "google-bert/bert-base-cased", 768, "en", "apache-2.0", "true"), ("bert-es", "dccuchile/bert-base-spanish-wwm-cased", 768, "es", "cc-by-4.0", "true"), ("bert-large", "google-bert/bert-large-uncased", 1024, "en", "apache-2.0", "true"),
    ("bert-multilingual", "google-bert/bert-base-multilingual-cased", 768, "es,en,pt", "apache-2.0", "false"), ("bert-multilingual-uncased", "google-bert/bert-base-multilingual-uncased", 768, "es,en,pt", "apache-2.0", "false"), ("bert-pt", "neuralmind/bert-base-portuguese-cased", 768, "pt", "mit", "true"), ("bert-tiny", "prajjwal1/bert-tiny", 128, "en", "mit", "true"),
    ("e5-multilingual-base", "intfloat/multilingual-e5-base", 768, "es,en,pt", "mit", "false"), ("e5-multilingual-small", "intfloat/multilingual-e5-small", 384, "es,en,pt", "mit", "false"), ("hashed-128", "hashed-words-128", 128, "es,en,pt", "apache-2.0", "false"), ("hashed-384", "hashed-words-384", 384, "es,en,pt", "apache-2.0", "false"),
)


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{m}', {d}, 512, '{l}', '{c}', {x})" for n, m, d, l, c, x in CATALOGUE) + ") t(encoder_name, model_id, embedding_dim, max_tokens, languages, license, complementary)")
def encoder_catalogue(table, spark):
    from fathomline.operators.encoding import catalogue

    return catalogue(spark)


@query()
def retrieve_end_to_end(table, spark):
    """Documents chunked, encoded and searched with the benchmark items as queries: the best documents of each.  Chunks,
    vectors and fused hits are stored, as several jobs read each of them."""
    from fathomline.config import ChunkingConfig
    from fathomline.operators import chunking
    from fathomline.operators.encoding import encode_pending
    from fathomline.plans.chunk_queries import _documents
    from fathomline.plans.registered import stored
    from fathomline.plans.retrieval import answered, fused_hits

    docs = _documents(table)
    chunks = stored(chunking.enrich(chunking.chunk(docs, ChunkingConfig(strategy="hybrid")), docs), "chunks")
    emb = stored(encode_pending(chunks, spark.createDataFrame([], "chunk_id string, encoder_name string, hash_texto string"), ["hashed-128"]), "vectors")
    asked = table("benchmark").select(F.format_string("q%03d", "item_id").alias("query_id"), F.col("text").alias("query_text"))
    return answered(stored(fused_hits(asked, emb, 20), "hits"), chunks, is_stored=True)[0]
