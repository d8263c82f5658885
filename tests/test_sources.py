"""Extractors, corpus scan, queries and streams on small inputs."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fathomline.sources import corpus, queries
from fathomline.sources.kernels import EXTRACTORS, decoded
from fathomline.streaming import streams


def test_markdown_and_text():
    title, _, _, s = EXTRACTORS.get("md")(b"# Uno\n\nHola\nmundo\n\n## Dos\n- a\n- b\n")
    assert title == "Uno" and s == [("Uno", "Hola\nmundo", True), ("Dos", "a\nb", True)]
    assert EXTRACTORS.get("txt")(b"a\r\n\r\nb")[3] == [(None, "a", True), (None, "b", True)]
    assert decoded("ñ".encode("latin-1")) == "ñ"


def test_html():
    page = '<html lang="es"><head><title>T &amp; t</title><meta name="date" content="2024-01-02"><style>p{}</style></head><body><h1>Uno</h1><p>a <b>b</b></p><script>x("<p>no</p>")</script><ul><li>c</li></ul><h2>Dos</h2><p>d</p></body></html>'
    assert EXTRACTORS.get("html")(page.encode()) == ("T & t", "es", "2024-01-02", [("Uno", "a b\n\nc", True), ("Dos", "d", True)])


def test_html_references_without_semicolon():
    page = "<title>a &amp; b &quot;c&quot; d&amp</title><h1>&am &notit; &a &#38; &#38</h1><p>&amp;lt; &eacute; x&quot</p>"
    assert EXTRACTORS.get("html")(page.encode()) == ('a & b "c" d&amp', None, None, [("&am &notit; &a & &#38", "&lt; é x&quot", True)])


def test_json():
    raw = json.dumps([{"title": "A", "body_paragraphs": ["uno", "dos;tres;cuatro;"], "date": "2026-07-30"}, {"titulo": "B", "contenido": {"x": ["y."]}}]).encode()
    title, _, date, s = EXTRACTORS.get("json")(raw)
    assert (title, date) == ("A", "2026-07-30") and s == [("A", "A.\nuno.\n\ndos. tres. cuatro.", True), ("B", "B.\ny.", True)]
    assert EXTRACTORS.get("json")(b'{"meta": 1, "items": [{"name": "n", "k": 2, "id": 3}]}')[3] == [("n", "n.\nk: 2.", True)]
    nested = {"title": "T", "author": "no", "sections": [{"heading": "H", "paragraphs": ["p1", {"text": "p2."}]}], "other": [{"name": "skip", "intro": "i"}], "links": ["l"]}
    assert EXTRACTORS.get("json")(json.dumps([nested, {"links": ["a", {"text": "b"}]}]).encode())[3] == [("T", "T.\nH.\n\np1.\n\np2.\n\ni.", True), (None, "a.\n\nb.", True)]


def test_csv_and_xlsx():
    assert EXTRACTORS.get("csv")("ciudad;poblacion\nBogotá;7\nx;\nbad;1;2\n".encode())[3] == [(None, "ciudad: Bogotá\npoblacion: 7", False), (None, "ciudad: x", False)]
    assert EXTRACTORS.get("csv")(b'a,,"c d"\n1,"x, y",\n\n2\n3,4,5,6\n')[3] == [(None, "a: 1\ncol_1: x, y", False), (None, "a: 2", False)]
    for bad in (b"a,b\n", b"", b"a,b\n,\n"):
        with pytest.raises(ValueError):
            EXTRACTORS.get("csv")(bad)
    with pytest.raises(ValueError, match="reader"):
        EXTRACTORS.get("xls")(b"\xd0\xcf\x11\xe0")
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>h</t></si><si><t>v</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>n</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="B2"><v>3</v></c></row></sheetData></worksheet>')
    assert EXTRACTORS.get("xlsx")(out.getvalue())[3] == [(None, "h: v\nn: 3", False)]


def test_vector_tile_and_pdf():
    def field(n, data):
        return bytes([n << 3 | 2, len(data)]) + data

    feature = bytes([1 << 3, 5]) + field(2, bytes([0, 0]))
    layer = field(1, b"roads") + field(2, feature) + field(2, feature) + field(3, b"name") + field(4, field(1, b"Calle 1"))
    assert EXTRACTORS.get("pbf")(field(3, layer))[3] == [("roads", "name: Calle 1", False)]
    assert EXTRACTORS.get("pdf")(b"BT (Hola mundo amigo) Tj (no) ET")[3] == [(None, "Hola mundo amigo", True)]
    with pytest.raises(ValueError, match="known"):
        EXTRACTORS.get("xyz")


def test_corpus(spark, tmp_path):
    for name, body in (("agua/inundacion.md", "# T\n\ntexto"), ("otros/sismo_2.txt", "a\n\nb"), ("otros/.hidden.txt", "x"), ("otros/img.png", "x"), ("otros/raro.xyz", "x"), ("otros/Thumbs.db", "x")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    topics = corpus.topic_map('{"Agua": 2, "sismo": "1", "bad": null}')
    assert topics == {"agua": 2, "sismo": 1}
    got = {r.doc_id: r for r in corpus.documents(spark, str(tmp_path), topics, 3).collect()}
    assert set(got) == {"agua/inundacion.md", "otros/sismo_2.txt", "otros/img.png", "otros/raro.xyz"}
    assert got["agua/inundacion.md"].fenomeno == 2 and got["otros/sismo_2.txt"].fenomeno == 1 and got["otros/raro.xyz"].fenomeno == 3
    assert len(got["otros/sismo_2.txt"].secciones) == 2 and "OCR" in got["otros/img.png"].error and "unknown" in got["otros/raro.xyz"].error
    assert corpus.scan(spark, str(tmp_path), [".MD"]).count() == 1
    assert [r.text for r in corpus.plain_texts(spark, str(tmp_path)).collect()] == ["# T\n\ntexto", "a\n\nb"]
    # agua, agua/inundacion.md, otros, otros/img.png, otros/raro.xyz, otros/sismo_2.txt: folders count
    assert [corpus.plain_texts(spark, str(tmp_path), n).count() for n in (1, 2, 5, 6)] == [0, 1, 1, 2]
    assert corpus.scan(spark, str(tmp_path / "absent")).count() == 0 and corpus.documents(spark, str(tmp_path / "absent"), topics, 3).count() == 0


def test_queries(spark, tmp_path):
    t = "Preguntas: q001 ¿Qué es\nesto? q002   Otra\n q003 Fin"
    got = spark.createDataFrame([(t,)], "t string").select(F.explode(queries.marked(F.col("t"))).alias("q")).select("q.*").collect()
    assert [tuple(r) for r in got] == [("q001", "¿Qué es esto?"), ("q002", "Otra"), ("q003", "Fin")]
    p = tmp_path / "q.jsonl"
    p.write_text('{"id": "q001", "text": "a"}\n{"query_id": "q001", "query_text": "b"}\n{"id": "q009", "text": "c"}\n{"id": "q002", "text": " "}\n')
    q = queries.load(spark, str(p))
    assert q.count() == 3
    assert {(r.query_id, r.problem) for r in queries.integrity(q, 1, 2).collect()} == {("q002", "missing"), ("q001", "repeated"), ("q009", "unexpected")}


def test_streaming_upsert_is_idempotent(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(source)
    for run in range(2):
        streams.upserting(spark.readStream.schema("k int, v string").parquet(source), target, ["k"], str(tmp_path / f"c{run}")).awaitTermination()
        assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string").write.mode("append").parquet(source)
    streams.upserting(spark.readStream.schema("k int, v string").parquet(source), target, ["k"], str(tmp_path / "c1")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_lenient_queries_and_truth(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"query": "uno"}\n{"id": "x", "texto": "dos"}\n{"query_text": " "}\n{"query_text": "tres", "query": "no"}\n')
    assert sorted(map(tuple, queries.load(spark, str(tmp_path / "q.jsonl")).collect())) == [("q001", "uno"), ("q003", "tres"), ("x", "dos")]
    (tmp_path / "gt.json").write_text('{"q001": {"fragmentos": [{"texto": "Texto A", "relevancia": 3}, "Texto B"], "documentos": ["archivo.pdf"]}}')
    (tmp_path / "gt.jsonl").write_text('{"query_id": "q002", "fragmentos": ["X"], "documentos": ["y.pdf"]}\n\n')
    f, d = queries.ground_truth(spark, str(tmp_path / "gt.json"))
    assert sorted(map(tuple, f.collect())) == [("q001", "Texto A", 3.0), ("q001", "Texto B", 1.0)] and [tuple(r) for r in d.collect()] == [("q001", "archivo.pdf")]
    f, d = queries.ground_truth(spark, str(tmp_path / "gt.jsonl"))
    assert [tuple(r) for r in f.collect()] == [("q002", "X", 1.0)] and [tuple(r) for r in d.collect()] == [("q002", "y.pdf")]
    (tmp_path / "r.jsonl").write_text('{"query_id": "q001", "documents": [{"rank": 1, "doc_id": "D"}], "fragments": [{"rank": 1, "chunk_id": "C", "doc_id": "D", "text": "T"}]}')
    docs, frags = queries.results(spark, str(tmp_path / "r.jsonl"))
    assert [tuple(r) for r in docs.collect()] == [("q001", 1, "D")] and [tuple(r) for r in frags.collect()] == [("q001", 1, "C", "D", "T")]
    from fathomline.operators import evaluation

    frags = spark.createDataFrame([("q001", 1, "texto a"), ("q001", 2, "nada"), ("q009", 1, "x")], "query_id string, rank int, texto string")
    truth, truth_docs = queries.ground_truth(spark, str(tmp_path / "gt.json"))
    docs = spark.createDataFrame([("q001", "x/archivo.pdf", 1)], "query_id string, doc_id string, rank int")
    means, top = evaluation.graded_report(frags, docs, truth, truth_docs)
    import math

    assert means == {"n_queries": 1, "ndcg": round(3 / (3 + 1 / math.log2(3)), 6), "f1": 0.5} and top.count() == 2
    assert evaluation.graded_report(frags, docs, truth.limit(0), truth_docs.limit(0))[0] == {"n_queries": 0, "ndcg": 0.0, "f1": 0.0}


def pdf_file(*pages: bytes, fonts: str = "/F1 << /Type /Font /BaseFont /Helvetica >>") -> bytes:
    """A file of pages with two fonts, the second bold; every other content stream is compressed."""
    import zlib

    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", 4: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica-Bold >>"}
    kids = []
    for i, content in enumerate(pages):
        n = 10 + 2 * i
        kids.append(f"{n} 0 R")
        objects[n] = f"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> /Contents {n + 1} 0 R >>".encode()
        data = zlib.compress(content) if i % 2 == 0 else content
        objects[n + 1] = b"<< " + (b"/Filter /FlateDecode " if i % 2 == 0 else b"") + f"/Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream"
    objects[2] = f"<< /Type /Pages /Kids [{' '.join(kids)}] /Count {len(pages)} >>".encode()
    return b"%PDF-1.4\n" + b"".join(f"{n} 0 obj\n".encode() + body + b"\nendobj\n" for n, body in objects.items()) + b"%%EOF"


def test_pdf_layout():
    one = b"BT /F1 10 Tf 1 0 0 1 50 600 Tm (Second block, first line) Tj 0 -12 Td (second line.) Tj ET BT /F1 18 Tf 1 0 0 1 50 700 Tm [(A ti) -20 (tle) -300 (here)] TJ ET BT /F1 10 Tf 1 0 0 1 300 600 Tm (to the \\(right\\)) Tj ET"
    two = b"BT /F2 12 Tf 50 500 Td (Bold heading) Tj ET BT /F1 10 Tf 50 400 Td <48656C6C6F> Tj 14 TL T* (next) Tj (nn rI) ' ET"
    title, _, _, s = EXTRACTORS.get("pdf")(pdf_file(one, two))
    assert title == "A title here"
    assert s == [("A title here", "A title here\n\nSecond block, first line second line.\n\nto the (right)", True), ("Bold heading", "Bold heading\n\nHello next", True)]
    with pytest.raises(ValueError, match="encrypted"):
        EXTRACTORS.get("pdf")(pdf_file(one) + b"trailer << /Encrypt 9 0 R >>")
    with pytest.raises(ValueError, match="OCR"):
        EXTRACTORS.get("pdf")(pdf_file(b"q 1 0 0 1 0 0 cm /Im0 Do Q"))


def test_pdf_unicode_map_and_object_stream():
    import zlib

    cmap = b"beginbfchar <0001> <00D1> endbfchar beginbfrange <0002> <0004> <0061> endbfrange"
    inner = [b"<< /Type /Font /Subtype /Type0 /BaseFont /Sub+X-Black /ToUnicode 8 0 R >>", b"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 5 0 R >> >> /Contents 7 0 R >>"]
    head = f"5 0 6 {len(inner[0]) + 1} ".encode()
    stream = zlib.compress(head + b"\n".join(inner))
    objects = {2: b"<< /Type /Pages /Kids [6 0 R] >>", 7: b"<< >>\nstream\nBT /F1 9 Tf 0 0 Td <0001000200030004> Tj ET\nendstream", 8: b"<< >>\nstream\n" + cmap + b"\nendstream", 9: f"<< /Type /ObjStm /N 2 /First {len(head)} /Filter /FlateDecode >>\nstream\n".encode() + stream + b"\nendstream"}
    raw = b"%PDF-1.5\n" + b"".join(f"{n} 0 obj\n".encode() + body + b"\nendobj\n" for n, body in objects.items())
    assert EXTRACTORS.get("pdf")(raw)[3] == [(None, "Ñabc", True)]


def test_osm_extract():
    import zlib

    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    num = lambda f, n: varint(f << 3) + varint(n)
    sub = lambda f, b: varint(f << 3 | 2) + varint(len(b)) + b
    packed = lambda f, ns: sub(f, b"".join(map(varint, ns)))
    strings = ["", "name", "Rio", "amenity", "school", "source", "x"]
    table = sub(1, b"".join(sub(1, x.encode()) for x in strings))
    dense = packed(1, [10 << 1, 1 << 1, 1 << 1]) + packed(10, [1, 2, 0, 0, 3, 4, 5, 6, 0])  # ids 10, 11, 12
    way = num(1, 7) + packed(2, [1]) + packed(3, [2])
    block = table + sub(2, sub(2, dense)) + sub(2, sub(3, way) + sub(3, way) + sub(4, num(1, 9) + packed(2, [3]) + packed(3, [4])))
    blob = lambda kind, data, squeeze: (lambda body: (lambda head: len(head).to_bytes(4, "big") + head + body)(sub(1, kind) + num(3, len(body))))(sub(3, zlib.compress(data)) if squeeze else sub(1, data))
    raw = blob(b"OSMHeader", b"", False) + blob(b"OSMData", block, True)
    assert EXTRACTORS.get("pbf")(raw)[3] == [("node", "name: Rio", False), ("node", "amenity: school", False), ("way", "name: Rio", False), ("relation", "amenity: school", False)]


def test_ocr_engines_plug_in():
    from fathomline.sources import kernels

    with pytest.raises(ValueError, match="OCR"):
        EXTRACTORS.get("png")(b"x")
    kernels.OCR.register("a-broken")(lambda raw, languages: 1 / 0)
    kernels.OCR.register("b-fake")(lambda raw, languages: f" {raw.decode()} in {languages[0]} ")
    try:
        assert EXTRACTORS.get("png")(b"text")[3] == [(None, "text in spa", True)]
        del kernels.OCR._known["b-fake"]
        with pytest.raises(ValueError, match="a-broken"):
            EXTRACTORS.get("png")(b"x")
    finally:
        kernels.OCR._known.clear()
