"""Registered queries on chunks: strategies, validation, sampling, storage, fragments."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.config import ChunkingConfig
from fathomline.functions import segment, text
from fathomline.operators import audit, chunking, fragments, store, validation
from fathomline.plans.registered import query

LINES = r"""
l AS (SELECT doc_id, orden, line, len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')) AS n FROM (SELECT doc_id, generate_subscripts(s, 1) - 1 AS orden, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
k AS (SELECT * FROM l WHERE trim(line) <> '')"""


def _lines(table):
    """The lines of documents as sections."""
    return table("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("orden", "texto"))


def _documents(table, splittable: bool = True, whole: bool = False):
    """Documents with their lines as sections, or with one section whose paragraphs are the lines."""
    section = lambda t, i: F.struct(F.lit(None).cast("string").alias("titulo"), t.alias("texto"), i.cast("int").alias("orden"), F.lit(splittable).alias("splittable"))
    sections = F.array(section(F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit(0))) if whole else F.transform(F.split("text", "\n"), section)
    return table("documents").select("doc_id", F.col("source").alias("fuente"), F.lit("txt").alias("formato"), (1 + F.col("doc_id") % 3).cast("int").alias("fenomeno"), sections.alias("secciones"))


CHUNK_ID = "doc_id || '__chunk_' || lpad(posicion::VARCHAR, 5, '0')"


@query(rf"""WITH {LINES}, p AS (SELECT doc_id, orden, i AS piece, CASE WHEN n <= 512 THEN line ELSE array_to_string(list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')[i * 512 + 1:i * 512 + 512], ' ') END AS t FROM (SELECT *, unnest(range(0, greatest(1, (n + 511) // 512))) AS i FROM k)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY orden, piece) - 1 AS posicion FROM p)
SELECT doc_id, {CHUNK_ID} AS chunk_id, sha256(t) AS hash_texto FROM r""")
def chunk_structural(table, spark):
    return chunking.chunk_sections(_lines(table)).select("doc_id", "chunk_id", text.text_hash(F.col("texto")).alias("hash_texto"))


@query(rf"""WITH {LINES}, p AS (SELECT doc_id, orden, i AS piece, CASE WHEN n <= 512 THEN trim(line, ' ' || chr(9)) ELSE array_to_string(list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')[i * 512 + 1:i * 512 + 512], ' ') END AS t FROM (SELECT *, unnest(range(0, greatest(1, (n + 511) // 512))) AS i FROM k)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY orden, piece) - 1 AS posicion FROM p)
SELECT doc_id, {CHUNK_ID} AS chunk_id, sha256(t) AS hash_texto FROM r""")
def chunk_paragraph(table, spark):
    out = chunking.chunk(_documents(table, whole=True), ChunkingConfig(strategy="paragraph"))
    return out.select("doc_id", "chunk_id", text.text_hash(F.col("texto")).alias("hash_texto"))


def windows_sql(size: int, overlap: int, over: int = 0) -> str:
    """Overlapping windows w(doc_id, i, e, units, nx, wn) over units u(doc_id, i, line, n) in SQL, for documents of more
    than `over` words: prefix sums, the end and the successor of the window that begins at each unit, and a recursion
    along the successors.  A part of a WITH RECURSIVE clause."""
    return f"""
d AS (SELECT doc_id, count(*) AS units, sum(n) AS total FROM u GROUP BY doc_id),
pe AS (SELECT u.*, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS pe, units, total FROM u JOIN d USING (doc_id)),
e AS (SELECT a.doc_id, a.i, a.units, a.total, greatest(a.i, max(b.i)) AS e FROM pe a LEFT JOIN pe b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.pe - (a.pe - a.n) <= {size} WHERE a.total > {over} GROUP BY a.doc_id, a.i, a.units, a.total),
s AS (SELECT e.doc_id, e.i, e.e, e.units, coalesce(min(b.i), e.e + 1) AS nx FROM e JOIN pe t ON t.doc_id = e.doc_id AND t.i = e.e LEFT JOIN pe b ON b.doc_id = e.doc_id AND b.i > e.i AND b.i <= e.e AND t.pe - (b.pe - b.n) <= {overlap} GROUP BY e.doc_id, e.i, e.e, e.units),
w AS (SELECT doc_id, i, e, units, nx, 0 AS wn FROM s WHERE i = 0 UNION ALL SELECT s.doc_id, s.i, s.e, s.units, s.nx, w.wn + 1 FROM w JOIN s ON s.doc_id = w.doc_id AND s.i = w.nx WHERE w.e < w.units - 1)"""


WINDOWS = rf"""WITH RECURSIVE {LINES},
u AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY orden) - 1 AS i, line, n FROM k), {windows_sql(400, 80, 400)}"""

#: Pieces of texts t(doc_id, wn, t) of at most 512 words, as chunks; overlap_con is the last chunk of the window before.
PIECES = rf""",
tw AS (SELECT *, list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '') AS ws FROM t),
pc AS (SELECT doc_id, wn, piece, CASE WHEN len(ws) <= 512 THEN t ELSE array_to_string(ws[piece * 512 + 1:piece * 512 + 512], ' ') END AS t, least(512, len(ws) - piece * 512) AS num_tokens FROM (SELECT *, unnest(range(0, greatest(1, (len(ws) + 511) // 512))) AS piece FROM tw)),
ch AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY wn, piece) - 1 AS posicion FROM pc),
lastc AS (SELECT doc_id, wn + 1 AS wn, max(posicion) AS posicion FROM ch GROUP BY doc_id, wn)
SELECT ch.doc_id, ch.doc_id || '__chunk_' || lpad(ch.posicion::VARCHAR, 5, '0') AS chunk_id, ch.posicion::BIGINT AS posicion, num_tokens::BIGINT AS num_tokens, l.doc_id || '__chunk_' || lpad(l.posicion::VARCHAR, 5, '0') AS overlap_con, sha256(t) AS hash_texto FROM ch LEFT JOIN lastc l ON l.doc_id = ch.doc_id AND l.wn = ch.wn"""

_MARKS = ".!?»›。！？．｡"
#: Sentences in SQL.  Pieces end after a closing mark; a piece whose last word is an abbreviation goes on; a piece of dots
#: alone goes as the piece before it.
SENTENCES = rf"""
p AS (SELECT doc_id, generate_subscripts(s, 1) AS j, trim(unnest(s), ' ' || chr(9) || chr(10) || chr(13)) AS p FROM (SELECT doc_id, string_split(regexp_replace({{text}}, '([{_MARKS}])\s*', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents)),
pf AS (SELECT *, CASE WHEN regexp_matches(p, '^\.+$') THEN NULL ELSE regexp_matches(p, '[{_MARKS}¡]$') AND NOT list_contains([{", ".join(f"'{w}'" for w in sorted(segment.ABBREVIATIONS))}], rtrim(lower(regexp_extract(rtrim(p, ' .' || chr(9) || chr(10)), '[^ ]*$')), '.,;:!?»›')) END AS f0 FROM p WHERE p <> ''),
pe0 AS (SELECT *, coalesce(last_value(f0 IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY j ROWS UNBOUNDED PRECEDING), true) AS f FROM pf),
ps AS (SELECT *, coalesce(sum(f::INT) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS i FROM pe0),
u AS (SELECT doc_id, i, line, len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: w <> '')) AS n FROM (SELECT doc_id, i, string_agg(p, ' ' ORDER BY j) AS line FROM ps GROUP BY doc_id, i))"""


@query(f"{WINDOWS} SELECT doc_id, wn::BIGINT AS wn, i::BIGINT AS first_unit, e::BIGINT AS last_unit FROM w")
def chunk_windows(table, spark):
    """The windows of `paragraph_overlap` over the lines of documents of more than 400 words: units, not text."""
    from collections.abc import Iterator

    import pyarrow as pa

    from fathomline.functions.segment import windows

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                costs = [n for n in (len(x.split()) for x in t.split("\n")) if n]
                if sum(costs) > 400:
                    rows += [(doc, i, a, b) for i, (a, b) in enumerate(windows(costs, 400, 80))]
            columns = [*zip(*rows)] or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "wn", "first_unit", "last_unit"])

    return table("documents").select("doc_id", "text").mapInArrow(pack, "doc_id bigint, wn bigint, first_unit bigint, last_unit bigint")


def _strategy(table, spark, strategy, whole):
    out = chunking.chunk(_documents(table, whole=whole), ChunkingConfig(strategy=strategy))
    return out.select("doc_id", "chunk_id", F.col("posicion").cast("long").alias("posicion"), F.col("num_tokens").cast("long").alias("num_tokens"), "overlap_con", text.text_hash(F.col("texto")).alias("hash_texto"))


_BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
_UNITS = "t AS (SELECT w.doc_id, w.wn, string_agg({line}, {joint} ORDER BY u.i) AS t FROM w JOIN u ON u.doc_id = w.doc_id AND u.i BETWEEN w.i AND w.e GROUP BY w.doc_id, w.wn{more})"
query(f"WITH RECURSIVE {SENTENCES.format(text='replace(text, chr(10), chr(10) || chr(10))')}, {windows_sql(400, 80)}, {_UNITS.format(line='u.line', joint=chr(39) + ' ' + chr(39), more='')}{PIECES}", "chunk_semantic")(partial(_strategy, strategy="semantic", whole=True))
query(f"{WINDOWS}, {_UNITS.format(line=f'trim(u.line, {_BLANKS})', joint='chr(10) || chr(10)', more=' UNION ALL SELECT doc_id, 0, replace(text, chr(10), chr(10) || chr(10)) FROM documents JOIN d USING (doc_id) WHERE total <= 400')}{PIECES}", "chunk_paragraph_overlap")(partial(_strategy, strategy="paragraph_overlap", whole=True))
query(name="chunk_hybrid")(partial(_strategy, strategy="hybrid", whole=False))

_WHOLE = "replace(text, chr(10), chr(10) || chr(10))"
_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
# One section a document, so nothing is merged: windows over sentences, a short last one absorbed by the one before.
query(
    f"""WITH RECURSIVE {SENTENCES.format(text=_WHOLE)}, {windows_sql(400, 80)},
wc AS (SELECT w.doc_id, w.wn, w.i, w.e, sum(u.n) AS cost FROM w JOIN u ON u.doc_id = w.doc_id AND u.i BETWEEN w.i AND w.e GROUP BY w.doc_id, w.wn, w.i, w.e),
wl AS (SELECT *, max(wn) OVER (PARTITION BY doc_id) AS top, lag(cost) OVER o AS pcost, lead(e) OVER o AS ne, lead(cost) OVER o AS ncost FROM wc WINDOW o AS (PARTITION BY doc_id ORDER BY wn)),
wa AS (SELECT doc_id, wn, i, CASE WHEN wn = top - 1 AND ncost < 50 AND cost + ncost <= 512 THEN ne ELSE e END AS e FROM wl WHERE NOT (wn = top AND wn > 0 AND cost < 50 AND pcost + cost <= 512)),
t AS (SELECT wa.doc_id, wa.wn, string_agg(u.line, ' ' ORDER BY u.i) AS t FROM wa JOIN u ON u.doc_id = wa.doc_id AND u.i BETWEEN wa.i AND wa.e WHERE wa.doc_id IN (SELECT doc_id FROM documents WHERE {_WORDS} > 400) GROUP BY wa.doc_id, wa.wn
  UNION ALL SELECT doc_id, 0, {_WHOLE} FROM documents WHERE {_WORDS} BETWEEN 1 AND 400){PIECES}""",
    "chunk_hybrid_windows",
)(partial(_strategy, strategy="hybrid", whole=True))


@query(rf"""WITH {SENTENCES.format(text='text')}, n AS (SELECT doc_id, text, {_WORDS} AS words FROM documents),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS total FROM u), b AS (SELECT doc_id, string_agg(line, ' ' ORDER BY i) AS t FROM c WHERE total <= 512 GROUP BY doc_id)
SELECT n.doc_id, sha256(CASE WHEN words <= 512 THEN text ELSE coalesce(t, array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')[1:512], ' ')) END) AS sha FROM n LEFT JOIN b USING (doc_id) WHERE words > 0""")
def encoder_input(table, spark):
    """What an encoder of 512 words gets of a text: all, the first whole sentences that fit, or a cut within the first."""
    from fathomline.operators.encoding import ENCODERS, inputs

    out = inputs(table("documents").select("doc_id", F.col("text").alias("texto")), ENCODERS.get("hashed-128"))
    return out.filter("input is not null").select("doc_id", text.text_hash(F.col("input")).alias("sha"))


@query("SELECT conv_id AS doc_id, turn AS posicion, lag(conv_id || '__chunk_' || lpad(turn::VARCHAR, 5, '0')) OVER (PARTITION BY conv_id ORDER BY turn) AS overlap_con FROM conversations")
def overlap_lineage(table, spark):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table("conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("posicion"), F.lag(text.chunk_id(F.col("conv_id"), F.col("turn"))).over(w).alias("overlap_con"))


# Chunks with faults put in by rule: blank text, unknown topics, gaps, repeated ids.
FAULTY = rf"""WITH {LINES}, c AS (SELECT doc_id, orden AS posicion, doc_id || '__chunk_' || lpad((orden - (CASE WHEN doc_id % 11 = 3 AND orden = 2 THEN 1 ELSE 0 END))::VARCHAR, 5, '0') AS chunk_id,
  CASE WHEN (doc_id + orden) % 29 = 0 THEN ' ' ELSE line END AS texto, CASE WHEN (doc_id + orden) % 31 = 0 THEN 9 ELSE 1 + doc_id % 3 END AS fenomeno, n AS num_tokens FROM l WHERE NOT (doc_id % 7 = 0 AND orden = 3)),
h AS (SELECT *, CASE WHEN trim(texto, ' ') = '' THEN 'obligatorio' WHEN fenomeno NOT IN (1, 2, 3) THEN 'fenomeno' WHEN num_tokens > 512 THEN 'num_tokens' END AS hard FROM c),
s AS (SELECT *, coalesce(hard, CASE WHEN dense_rank() OVER (PARTITION BY doc_id ORDER BY posicion) - 1 <> posicion THEN 'secuencia' END) AS r1 FROM h),
v AS (SELECT *, coalesce(r1, CASE WHEN row_number() OVER (PARTITION BY chunk_id, r1 IS NULL ORDER BY doc_id, posicion) > 1 THEN 'duplicado' END) AS rule FROM s)"""


def _validated(table):
    l = _lines(table).filter(~((F.col("doc_id") % 7 == 0) & (F.col("orden") == 3)))
    shifted = F.col("orden") - F.when((F.col("doc_id") % 11 == 3) & (F.col("orden") == 2), 1).otherwise(0)
    chunks = l.select(
        "doc_id", text.chunk_id(F.col("doc_id"), shifted).alias("chunk_id"), F.lit("f").alias("fuente"), F.lit("txt").alias("formato"),
        F.when((F.col("doc_id") + F.col("orden")) % 31 == 0, 9).otherwise(1 + F.col("doc_id") % 3).alias("fenomeno"), F.col("orden").alias("posicion"), text.word_count(F.col("texto")).alias("num_tokens"),
        F.when((F.col("doc_id") + F.col("orden")) % 29 == 0, " ").otherwise(F.col("texto")).alias("texto"), F.col("orden").alias("input_ordinal"),
    )
    return validation.validate(chunks)


@query(f"{FAULTY} SELECT doc_id, posicion::BIGINT AS posicion, rule FROM v")
def validate_chunks(table, spark):
    return _validated(table).select("doc_id", F.col("posicion").cast("long").alias("posicion"), "rule")


@query(f"{FAULTY} SELECT rule, count(*) AS n FROM v WHERE rule IS NOT NULL GROUP BY rule")
def rejection_report(table, spark):
    return audit.rejections_by_rule(_validated(table))


@query(f"{FAULTY} SELECT doc_id, rejected::BIGINT AS rejected, round(rejected / greatest(n, rejected)::DOUBLE, 6) AS ratio FROM (SELECT doc_id, sum((rule IS NOT NULL)::INT) AS rejected, max(posicion) + 1 AS n FROM v GROUP BY doc_id) WHERE rejected > 0")
def rejection_ratio(table, spark):
    return audit.rejection_ratio(_validated(table)).select("doc_id", "rejected", F.round("ratio", 6).alias("ratio"))


@query("""WITH a AS (SELECT DISTINCT lang FROM documents), b AS (SELECT lang, 100 // (SELECT count(*) FROM a) + (row_number() OVER (ORDER BY lang) <= 100 % (SELECT count(*) FROM a))::INT AS q FROM a),
s AS (SELECT DISTINCT lang, source FROM documents), c AS (SELECT lang, source, q // count(*) OVER (PARTITION BY lang) + (row_number() OVER (PARTITION BY lang ORDER BY source) <= q % count(*) OVER (PARTITION BY lang))::INT AS q FROM s JOIN b USING (lang)),
r AS (SELECT d.doc_id, d.lang, d.source, q, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents d JOIN c USING (lang, source)) SELECT doc_id, lang, source FROM r WHERE r <= q""")
def balanced_sample(table, spark):
    """A sampling operator: 100 rows, dealt over languages and then sources."""
    return store.balanced_sample(table("documents").select("doc_id", "lang", "source"), 100, ["lang", "source"], ["doc_id"])


SUMMARY = "count(*) AS files, sum((status = 'ok')::INT)::BIGINT AS ok, sum((status <> 'ok')::INT)::BIGINT AS errors, sum(CASE WHEN status = 'ok' THEN n ELSE 0 END)::BIGINT AS chunks"


@query(f"""WITH o AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'error' ELSE 'ok' END AS status, o_orderkey % 7 AS n, CASE WHEN o_custkey % 4 > 0 THEN (o_custkey % 4)::INT END AS fenomeno FROM orders)
SELECT 'total' AS scope, NULL::INT AS fenomeno, {SUMMARY} FROM o UNION ALL SELECT fenomeno::VARCHAR, fenomeno, {SUMMARY} FROM o WHERE fenomeno IS NOT NULL GROUP BY fenomeno""")
def batch_summary(table, spark):
    o = table("orders").select(F.when(F.col("o_orderkey") % 10 == 0, "error").otherwise("ok").alias("status"), (F.col("o_orderkey") % 7).alias("num_guardados"), F.when(F.col("o_custkey") % 4 > 0, F.col("o_custkey") % 4).cast("int").alias("fenomeno"))
    return audit.batch_summary(o)


MERGED = r"""WITH c AS (SELECT conv_id AS doc_id, turn AS posicion, min(text) AS texto, len(list_filter(regexp_split_to_array(min(text), '\s+'), lambda w: w <> '')) AS n FROM conversations GROUP BY conv_id, turn)
SELECT a.doc_id, a.posicion, CASE WHEN a.n <= 250 AND a.n + b.n <= 250 THEN a.doc_id || '::' || (a.posicion + 1) END AS merged_with, sha256(CASE WHEN a.n <= 250 AND a.n + b.n <= 250 THEN a.texto || ' ' || b.texto ELSE a.texto END) AS hash_texto
FROM c a LEFT JOIN c b ON a.doc_id = b.doc_id AND b.posicion = a.posicion + 1"""


@query(MERGED)
def merge_next_chunk(table, spark):
    c = table("conversations").groupBy(F.col("conv_id").alias("doc_id"), F.col("turn").alias("posicion")).agg(F.min("text").alias("texto"))
    return fragments.merged_next(c, c).select("doc_id", "posicion", "merged_with", text.text_hash(F.col("texto")).alias("hash_texto"))


@query(rf"""WITH RECURSIVE p AS (SELECT doc_id, generate_subscripts(s, 1) AS j, trim(unnest(s), {_BLANKS}) AS p FROM (SELECT doc_id, string_split(regexp_replace(text, '([{_MARKS}])\s*', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents)),
u AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY j) - 1 AS i, p AS line, len(list_filter(regexp_split_to_array(p, '\s+'), lambda w: w <> '')) AS n FROM p WHERE p <> ''), {windows_sql(250, 0)},
n AS (SELECT doc_id, text, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS words FROM documents),
f AS (SELECT w.doc_id, w.wn + 1 AS sub_indice, string_agg(u.line, ' ' ORDER BY u.i) AS t FROM w JOIN u ON u.doc_id = w.doc_id AND u.i BETWEEN w.i AND w.e JOIN n ON n.doc_id = w.doc_id WHERE n.words > 250 GROUP BY w.doc_id, w.wn UNION ALL SELECT doc_id, 0, text FROM n WHERE words <= 250)
SELECT doc_id, sub_indice::BIGINT AS sub_indice, len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) AS words, sha256(t) AS hash_texto FROM f""")
def split_long_fragments(table, spark):
    out = fragments.split_long(table("documents").select("doc_id", F.col("text").alias("texto")))
    return out.select("doc_id", F.col("sub_indice").cast("long").alias("sub_indice"), text.word_count(F.col("texto")).cast("long").alias("words"), text.text_hash(F.col("texto")).alias("hash_texto"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS created FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""")
def upsert_merge(table, spark):
    """Old rows are the even keys (created 1), new ones every third (created 2, price + 1); creation stays."""
    o = table("orders").select("o_orderkey", "o_totalprice")
    old = o.filter(F.col("o_orderkey") % 2 == 0).withColumn("created", F.lit(1))
    new = o.filter(F.col("o_orderkey") % 3 == 0).select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(2).alias("created"))
    return store.upsert(old, new, ["o_orderkey"], keep_from_old=("created",))


@query("SELECT doc_id AS chunk_id FROM documents WHERE doc_id % 5 IN (0, 1)")
def pending_by_hash(table, spark):
    """The cache lacks every fifth document and has another text for the next."""
    d = table("documents").select(F.col("doc_id").alias("chunk_id"), text.text_hash(F.col("text")).alias("hash_texto"))
    cache = d.filter(F.col("chunk_id") % 5 != 0).withColumn("hash_texto", F.when(F.col("chunk_id") % 5 == 1, F.lit("old")).otherwise(F.col("hash_texto")))
    return store.pending(d, cache).select("chunk_id")


@query("SELECT fenomeno, formato, count(*) AS n, sum((words < 50)::INT)::BIGINT AS small FROM (SELECT 1 + doc_id % 3 AS fenomeno, source AS formato, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS words FROM documents) GROUP BY fenomeno, formato")
def counts_by_stratum(table, spark):
    d = table("documents").select((1 + F.col("doc_id") % 3).alias("fenomeno"), F.col("source").alias("formato"), text.word_count(F.col("text")).alias("words"))
    return d.groupBy("fenomeno", "formato").agg(F.count("*").alias("n"), F.sum((F.col("words") < 50).cast("int")).alias("small"))
