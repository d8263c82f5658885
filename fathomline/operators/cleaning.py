"""Boilerplate lines, cleaning of documents, language guess."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text


def lines(df: DataFrame, keys: list[str], column: str = "texto") -> DataFrame:
    """(keys, n, line): the \\n-split lines of a text, numbered from 0."""
    return df.select(*keys, F.posexplode(F.split(column, "\n")).alias("n", "line"))


def local_boilerplate(sections: DataFrame, least: int = 2) -> DataFrame:
    """(doc_id, line): candidate lines in at least so many sections (doc_id, orden, texto) of one document."""
    found = lines(sections, ["doc_id", "orden"]).select("doc_id", "orden", F.trim("line").alias("line")).filter(text.boilerplate_candidate(F.col("line")))
    return found.groupBy("doc_id", "line").agg(F.countDistinct("orden").alias("n_sections")).filter(F.col("n_sections") >= least)


def corpus_boilerplate(documents: DataFrame, least: int = 3) -> DataFrame:
    """(line, n_docs): candidate lines in at least so many documents (doc_id, texto); counted once a document."""
    found = lines(documents, ["doc_id"]).select("doc_id", F.trim("line").alias("line")).filter(text.boilerplate_candidate(F.col("line"))).distinct()
    return found.groupBy("line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= least)


def gone_lines(documents: DataFrame, boilerplate: DataFrame) -> DataFrame:
    """(doc_id, gone): for each document (doc_id, texto) that holds lines of boilerplate([doc_id,] line), these lines.

    Only candidate lines, once a document, meet the boilerplate; Spark broadcasts the latter only where its size allows,
    and an array has no more lines than the document's own.
    """
    keys = [c for c in ("doc_id", "line") if c in boilerplate.columns]
    own = lines(documents, ["doc_id"]).select("doc_id", F.trim("line").alias("line")).filter(text.boilerplate_candidate(F.col("line"))).distinct()
    return own.join(boilerplate.select(*keys).distinct(), keys, "left_semi").groupBy("doc_id").agg(F.collect_set("line").alias("gone"))


def dropped_lines(t: Column, gone: Column) -> Column:
    """A text without the lines that are in the array, blanks at their ends aside; the order of lines stays."""
    return F.array_join(F.filter(F.split(t, "\n"), lambda x: ~F.array_contains(gone, F.trim(x))), "\n")


def without_boilerplate(documents: DataFrame, boilerplate: DataFrame) -> DataFrame:
    """(doc_id, texto) without the lines in boilerplate([doc_id,] line).  Only documents that hold one are taken apart;
    the others' texts go on as they are."""
    found = gone_lines(documents, boilerplate)
    joined = documents.select("doc_id", "texto").join(found, "doc_id", "left")
    return joined.select("doc_id", F.when(F.col("gone").isNull(), F.coalesce("texto", F.lit(""))).otherwise(dropped_lines(F.col("texto"), F.col("gone"))).alias("texto"))


def cleaned_documents(documents: DataFrame, *, local_least: int = 2, corpus_least: int = 3, default_language: str = "es") -> DataFrame:
    """documents (doc_id, secciones, ...) with clean sections and `idioma`, in a fixed order of steps.

    Language (of the first three sections, where the document has none) and boilerplate (lines in local_least sections
    of a document, or in corpus_least documents) are found on raw texts.  Then controls and blanks are cleaned, lines of
    either kind are dropped from sections that may be split, and ends are trimmed.  Atomic sections keep their lines.
    A null section text becomes empty.
    """
    section = lambda s: F.coalesce(s["texto"], F.lit(""))
    raw = documents.select("doc_id", F.explode("secciones").alias("s")).select("doc_id", F.col("s.orden").alias("orden"), F.coalesce("s.texto", F.lit("")).alias("texto"))
    own = lines(raw, ["doc_id", "orden"]).select("doc_id", "orden", F.trim("line").alias("line")).filter(text.boilerplate_candidate(F.col("line"))).distinct()
    by_doc = own.groupBy("doc_id", "line").agg(F.count("*").alias("n"))  # a row a line of a document
    corpus = by_doc.groupBy("line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= corpus_least).select("line")
    local = by_doc.filter(F.col("n") >= local_least).select("doc_id", "line")
    gone = local.unionByName(by_doc.select("doc_id", "line").join(corpus, "line", "left_semi").select("doc_id", "line")).groupBy("doc_id").agg(F.collect_set("line").alias("_gone"))
    joined = documents.join(gone, "doc_id", "left")
    strip = lambda t: F.regexp_replace(t, r"^\s+|\s+$", "")
    spaced = lambda t: text.collapse_blanks(text.strip_controls(t))
    kept = lambda s: F.when(F.col("_gone").isNotNull() & F.coalesce(s["splittable"], F.lit(True)), dropped_lines(spaced(section(s)), F.col("_gone"))).otherwise(spaced(section(s)))
    head = F.array_join(F.transform(F.slice("secciones", 1, 3), section), " ")
    guess = language_guess(head, default_language)
    idioma = F.coalesce("idioma", guess) if "idioma" in documents.columns else guess
    return joined.withColumn("idioma", idioma).withColumn("secciones", F.transform("secciones", lambda s: s.withField("texto", strip(kept(s))))).drop("_gone")


def cleaned(t: Column) -> Column:
    """Controls, blanks, ends, in this order."""
    return F.regexp_replace(text.collapse_blanks(text.strip_controls(t)), r"^\s+|\s+$", "")


#: Frequent function words by language.
STOP_WORDS = {
    "de": ("der", "die", "und", "das", "ist", "nicht", "von", "mit", "für", "auf", "sich"),
    "en": ("the", "and", "of", "to", "is", "that", "was", "for", "with", "this", "from"),
    "es": ("el", "los", "que", "del", "por", "una", "con", "para", "las", "como", "y"),
    "fr": ("le", "les", "des", "et", "est", "dans", "pour", "qui", "sur", "une", "du"),
}


def language_guess(t: Column, default: str = "es", least_chars: int = 50) -> Column:
    """The language with most stop words (alphabetical order breaks ties); default for short texts and no hits."""
    low = F.lower(t)
    # a regular expression a language counts whole words without making arrays of them
    hits = [F.struct(F.regexp_count(low, F.lit(rf"(?U)(?<!\S)(?:{'|'.join(ws)})(?!\S)")).alias("n"), F.lit(-i).alias("o"), F.lit(lang).alias("lang")) for i, (lang, ws) in enumerate(sorted(STOP_WORDS.items()))]
    # the one-element array binds the best hit, which is read twice, to a name
    named = F.transform(F.array(F.greatest(*hits)), lambda best: F.when(best["n"] > 0, best["lang"]))
    return F.coalesce(F.when(F.length(t) >= least_chars, F.get(named, 0)), F.lit(default))
