"""Registered queries on readers: table rows written as files of a format, extracted again, and compared with SQL on the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.operators import cleaning, entities, export, graph
from fathomline.plans.registered import query, shared_path
from fathomline.plans.text_queries import _STOP, CANDIDATE, CONTROLS, guess_sql
from fathomline.sources import corpus, graphml
from fathomline.sources import queries as query_source


def extracted(rows, ext: str):
    """(path, titulo, orden, texto, splittable) of rows (path, content) as files of one format."""
    files = rows.select(F.col("path").cast("string").alias("path"), F.col("content").cast("binary").alias("content"), F.lit(ext).alias("ext"))
    return corpus.extract(files).select("path", F.explode("secciones").alias("s")).select("path", "s.titulo", "s.orden", "s.texto", "s.splittable")


@query(r"""SELECT p_partkey::VARCHAR AS path, 'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || trim(p_name) || chr(10) || 'p_brand: ' || trim(p_brand) || chr(10) || 'col_3: ' || trim(p_type) || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE chr(10) || 'p_size: ' || p_size END AS texto, p_partkey % 7 = 0 AS second FROM part
UNION ALL SELECT p_partkey::VARCHAR, 'p_partkey: again', p_partkey % 7 = 0 FROM part WHERE p_partkey % 7 = 0""")
def csv_rows(table, spark):
    """A CSV file a part: a blank header, quoted commas, short rows, rows that are too long, blank values."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    row = F.concat_ws(",", F.col("p_partkey").cast("string"), quoted("p_name"), quoted("p_brand"), quoted("p_type"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_size").cast("string")))
    more = F.when(F.col("p_partkey") % 7 == 0, "again,,,,\n").otherwise("too,long,for,the,header,of,it\n")
    rows = table("part").select(F.col("p_partkey").alias("path"), F.concat(F.lit("p_partkey,p_name,p_brand,,p_size\n"), row, F.lit("\n"), more).alias("content"))
    return extracted(rows, "csv").select("path", "texto", (F.col("path").cast("long") % 7 == 0).alias("second"))


_STRIP = r"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"
_NORM = rf"CASE WHEN len({{x}}) - len(replace({{x}}, ';', '')) >= 2 AND NOT regexp_matches({{x}}, '[.!?:»›]$') THEN array_to_string(list_transform(list_filter(list_transform(string_split({{x}}, ';'), lambda y: {_STRIP.format(x='y')}), lambda y: y <> ''), lambda y: {_STOP.format(x='y')}), ' ') ELSE {_STOP.format(x='{x}')} END"


@query(rf"""WITH t AS (SELECT conv_id || '-' || turn AS path, role, {_STRIP.format(x='text')} AS t FROM conversations)
SELECT path, role AS titulo, sha256(role || '.' || chr(10) || role || '.' || chr(10) || chr(10) || regexp_replace({_NORM.format(x='t')}, '\n{{3,}}', chr(10) || chr(10), 'g')) AS sha FROM t""")
def json_records(table, spark):
    """A JSON file a turn, its text nested in sections and paragraphs; metadata and titles are no body."""
    section = F.struct(F.col("role").alias("heading"), F.array("text").alias("paragraphs"))
    record = F.to_json(F.struct(F.col("role").alias("title"), F.lit("http://x").alias("url"), F.lit("2024-01-02").alias("date"), F.array(section).alias("sections")))
    rows = table("conversations").select(F.concat_ws("-", "conv_id", "turn").alias("path"), record.alias("content"))
    return extracted(rows, "json").select("path", "titulo", text.text_hash(F.col("texto")).alias("sha"))


@query(r"""WITH l AS (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
m AS (SELECT doc_id, i, CASE WHEN i % 5 = 1 THEN '# ' || x ELSE x END AS x FROM l),
k AS (SELECT *, regexp_matches(x, '^\s{0,3}#{1,6}\s+') AS head, NOT regexp_matches(x, '\S') AS blank FROM m),
g AS (SELECT *, sum((head OR blank)::INT) OVER w AS grp, last_value(CASE WHEN head THEN regexp_extract(x, '^\s{0,3}#{1,6}\s+(.*?)\s*#*\s*$', 1) END IGNORE NULLS) OVER w AS titulo FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
s AS (SELECT doc_id, grp, min(titulo) AS titulo, trim(string_agg(rtrim(regexp_replace(x, '^\s*(?:[-*+]|\d+[.)])\s+', ''), ' ' || chr(9) || chr(13)), chr(10) ORDER BY i), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM g WHERE NOT head AND NOT blank GROUP BY doc_id, grp)
SELECT doc_id::VARCHAR AS path, nullif(trim(titulo), '') AS titulo, row_number() OVER (PARTITION BY doc_id ORDER BY grp) - 1 AS orden, sha256(t) AS sha FROM s WHERE t <> ''""")
def markdown_sections(table, spark):
    """Documents as Markdown, every fifth line a heading, through the extractor."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 5 == 0, F.concat(F.lit("# "), x)).otherwise(x))
    rows = table("documents").select(F.col("doc_id").alias("path"), F.array_join(lines, "\n").alias("content"))
    return extracted(rows, "md").select("path", "titulo", F.col("orden").cast("long").alias("orden"), text.text_hash(F.col("texto")).alias("sha"))


@query(rf"""SELECT doc_id::VARCHAR AS path, sha256({_STRIP.format(x="regexp_replace(text, '[^\x00-\x7f¡-ÿ]', '?', 'g')")}) AS sha FROM documents WHERE regexp_matches(text, '\S')""")
def text_files(table, spark):
    """Text files in Latin-1 for every other document and in UTF-8 with a mark for the rest: decoding, one block each."""
    t = F.regexp_replace("text", r"[^\x00-\x7f¡-ÿ]", "?")
    content = F.when(F.col("doc_id") % 2 == 0, F.encode(t, "ISO-8859-1")).otherwise(F.encode(F.concat(F.lit("﻿"), t), "UTF-8"))
    return extracted(table("documents").select(F.col("doc_id").alias("path"), content.alias("content")), "txt").select("path", text.text_hash(F.col("texto")).alias("sha"))


@query(r"""SELECT page_id, string_split(url, '/')[-1] AS name, CASE WHEN contains(url, '/') THEN array_to_string(string_split(url, '/')[1:2], '/') ELSE url END AS folder FROM pages""")
def path_parts(table, spark):
    return table("pages").select("page_id", text.file_name(F.col("url")).alias("name"), text.folder(F.col("url")).alias("folder"))


_SPACED = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({{t}}, '{CONTROLS}', '', 'g'), '[ \t]+', ' ', 'g'), ' +\n', chr(10), 'g'), '\n{{{{3,}}}}', chr(10) || chr(10), 'g')"


@query(rf"""WITH l AS (SELECT conv_id AS doc_id, turn, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM conversations),
c AS (SELECT DISTINCT doc_id, turn, line FROM l WHERE {CANDIDATE}),
local AS (SELECT doc_id, line FROM c GROUP BY doc_id, line HAVING count(*) >= 2),
wide AS (SELECT line FROM c GROUP BY line HAVING count(DISTINCT doc_id) >= 3),
gone AS (SELECT doc_id, line FROM local UNION SELECT DISTINCT doc_id, line FROM c WHERE line IN (SELECT line FROM wide)),
x AS (SELECT conv_id AS doc_id, turn, generate_subscripts(s, 1) AS i, unnest(s) AS x FROM (SELECT conv_id, turn, string_split({_SPACED.format(t='text')}, chr(10)) AS s FROM conversations)),
k AS (SELECT x.doc_id, x.turn, string_agg(x.x, chr(10) ORDER BY i) AS t FROM x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.line = trim(x.x, ' ') WHERE g.line IS NULL OR x.turn % 4 = 3 GROUP BY x.doc_id, x.turn),
h AS (SELECT conv_id AS doc_id, string_agg(text, ' ' ORDER BY turn) AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r <= 3 GROUP BY conv_id),
{guess_sql('h')}
SELECT v.conv_id AS doc_id, v.turn AS orden, idioma, sha256(regexp_replace(regexp_replace(coalesce(t, ''), '^\s+', ''), '\s+$', '')) AS sha FROM conversations v LEFT JOIN k ON k.doc_id = v.conv_id AND k.turn = v.turn JOIN guess ON guess.doc_id = v.conv_id""")
def cleaned_documents(table, spark):
    """Conversations as documents, turns as sections, every fourth one atomic: language and boilerplate on raw texts, then the rest."""
    section = F.struct(F.lit(None).cast("string").alias("titulo"), F.col("text").alias("texto"), F.col("turn").cast("int").alias("orden"), (F.col("turn") % 4 != 3).alias("splittable"))
    docs = table("conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", section.alias("s")))).alias("s")).select("doc_id", F.transform("s", lambda x: x["s"]).alias("secciones"))
    out = cleaning.cleaned_documents(docs).select("doc_id", "idioma", F.explode("secciones").alias("s"))
    return out.select("doc_id", F.col("s.orden").cast("long").alias("orden"), "idioma", text.text_hash(F.col("s.texto")).alias("sha"))


@query("SELECT 'q' || printf('%03d', item_id) AS query_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS query_text FROM benchmark")
def queries_roundtrip(table, spark):
    """Queries exported as JSON lines, and loaded again."""
    path = shared_path(spark, "queries")
    rows = table("benchmark").select(F.format_string("q%03d", "item_id").alias("query_id"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("query_text"))
    export.queries_export(rows, path)
    export.queries_export(rows.limit(0), path)  # what is there stays
    return query_source.load(spark, path)


@query("SELECT n_name AS id, n_name AS nombre, 'PAIS' AS tipo, r_name AS region, round(n_nationkey / 7.0, 6)::DOUBLE AS confianza FROM nation JOIN region ON n_regionkey = r_regionkey")
def graphml_roundtrip(table, spark):
    """Nations and regions as a graph, written as GraphML and read again."""
    path = f"{shared_path(spark, 'graph')}.graphml"
    both = table("nation").join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nodes = both.select(F.col("n_name").alias("id"), F.col("n_name").alias("nombre"), F.lit("PAIS").alias("tipo")).unionByName(table("region").select(F.col("r_name").alias("id"), F.col("r_name").alias("nombre"), F.lit("REGION").alias("tipo")))
    triples = both.select(F.col("n_name").alias("sujeto"), F.lit("UBICADO_EN").alias("relacion"), F.col("r_name").alias("objeto"), F.lit("d").alias("doc_id"), F.lit("c").alias("chunk_id"), F.lit(None).cast("string").alias("evidencia"), (F.col("n_nationkey") / 7.0).alias("confianza"))
    graphml.write(nodes, triples, path)
    found, edges = graphml.read(spark, path)
    return found.join(edges, F.col("id") == F.col("sujeto")).select("id", "nombre", "tipo", F.col("objeto").alias("region"), "confianza")


#: Sentences by the number of a supplier, and the relation that a reader would name.
SAID = (("coopera con", "COOPERA_CON"), ("está ubicado en", "UBICADO_EN"), ("Es Parte de", "ES_PARTE_DE"), ("y", "COOCURRENCIA"), ("causa", "CAUSA"), ("amenaza a", "AFECTA"), ("es miembro de", "ES_PARTE_DE"), ("depends on", "DEPENDE_DE"), ("se opone, a", "OPONE_A"), ("includes", "INVOLUCRA"), ("linked to", "RELACIONADO_CON"), ("owned-by", "PERTENECE_A"))


@query(f"SELECT s_suppkey, CASE s_suppkey % {len(SAID)} {' '.join(f'WHEN {i} THEN {chr(39)}{kind}{chr(39)}' for i, (_, kind) in enumerate(SAID))} END AS relacion FROM supplier")
def relation_types(table, spark):
    """The relation of a sentence by its verb, in spite of accents, case and punctuation."""
    verb = F.element_at(F.array(*[F.lit(v) for v, _ in SAID]), (F.col("s_suppkey") % len(SAID) + 1).cast("int"))
    sentence = F.concat(F.lit("El proveedor "), "s_suppkey", F.lit(" "), verb, F.lit(" la fábrica."))
    return table("supplier").select("s_suppkey", graph.relation_of(sentence).alias("relacion"))


_KEY = r"trim(regexp_replace(regexp_replace(lower(strip_accents({t})), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"SELECT doc_id, contains(' ' || {_KEY.format(t='text')} || ' ', ' the ') OR contains(' ' || {_KEY.format(t='text')} || ' ', ' que la ') AS presente FROM documents")
def entity_presence(table, spark):
    """Whether a name or a variant of it stands in a text as whole words."""
    return table("documents").select("doc_id", entities.present(F.col("text"), F.array(F.lit("The"), F.lit("que,  lá"), F.lit(""))).alias("presente"))
