"""Relation extraction by pluggable models: entailment scoring and generated triplets.

Models are functions over lists, so that a worker loads one once; the tests' stand-ins are plain Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.text import entity_key
from fathomline.operators.entities import key, parse_triplets
from fathomline.operators.graph import cooccurrence, symbolic_triples
from fathomline.registry import Registry

#: Hypotheses by relation type; {s} and {o} are the subject's and the object's name.
HYPOTHESES = (
    ("UBICADO_EN", "{s} está ubicado en {o}"), ("UBICADO_EN", "{s} se encuentra en {o}"), ("UBICADO_EN", "{s} is located in {o}"),
    ("ES_PARTE_DE", "{s} es parte de {o}"), ("ES_PARTE_DE", "{s} es miembro de {o}"), ("ES_PARTE_DE", "{s} is part of {o}"), ("ES_PARTE_DE", "{s} is a member of {o}"),
    ("PARTE_DE", "{s} parte de {o}"), ("PARTE_DE", "{s} part of {o}"),
    ("PERTENECE_A", "{s} pertenece a {o}"), ("PERTENECE_A", "{s} es propiedad de {o}"), ("PERTENECE_A", "{s} belongs to {o}"),
    ("AFECTA", "{s} afecta a {o}"), ("AFECTA", "{s} amenaza a {o}"), ("AFECTA", "{s} affects {o}"), ("AFECTA", "{s} threatens {o}"),
    ("CAUSA", "{s} causa {o}"), ("CAUSA", "{s} provoca {o}"), ("CAUSA", "{s} causes {o}"),
    ("DEPENDE_DE", "{s} depende de {o}"), ("DEPENDE_DE", "{s} depends on {o}"),
    ("COOPERA_CON", "{s} coopera con {o}"), ("COOPERA_CON", "{s} colabora con {o}"), ("COOPERA_CON", "{s} cooperates with {o}"), ("COOPERA_CON", "{s} collaborates with {o}"),
    ("OPONE_A", "{s} se opone a {o}"), ("OPONE_A", "{s} está en conflicto con {o}"), ("OPONE_A", "{s} opposes {o}"),
    ("INVOLUCRA", "{s} involucra a {o}"), ("INVOLUCRA", "{s} incluye a {o}"), ("INVOLUCRA", "{s} involves {o}"), ("INVOLUCRA", "{s} includes {o}"),
    ("RELACIONADO_CON", "{s} está relacionado con {o}"), ("RELACIONADO_CON", "{s} está vinculado a {o}"), ("RELACIONADO_CON", "{s} is related to {o}"),
)

#: Generated relation phrases by relation type.
PHRASES = {
    phrase: kind
    for kind, phrases in (
        ("UBICADO_EN", ("located in", "located at", "based in", "headquartered in", "headquarters location", "country", "capital", "work location", "ubicado en", "se encuentra en")),
        ("ES_PARTE_DE", ("part of", "is part of", "member of", "es parte de", "es miembro de")),
        ("PARTE_DE", ("subsidiary of", "parent organization")),
        ("PERTENECE_A", ("pertenece a", "belongs to", "owned by", "employer", "owner of", "controls", "head of", "leader", "president")),
        ("AFECTA", ("affects", "threatens", "impacts", "influences", "afecta", "amenaza")),
        ("CAUSA", ("causes", "triggers", "causa", "provoca")),
        ("DEPENDE_DE", ("depends on", "depende de")),
        ("COOPERA_CON", ("cooperates with", "collaborates with", "partnership with", "alliance with", "coopera con", "colabora con")),
        ("OPONE_A", ("opposes", "conflict with", "military conflict", "armed conflict", "se opone a", "en conflicto con")),
        ("INVOLUCRA", ("involves", "includes", "participant in", "uses", "develops", "produces", "manufactures", "operates", "involucra", "incluye")),
        ("RELACIONADO_CON", ("related to", "associated with", "linked to", "relacionado con", "vinculado a")),
    )
    for phrase in phrases
}

#: Relation extractors by name: functions of (sentences, mentions, ...) that give triples.
RELATIONS: Registry = Registry("relation extractor")
RELATIONS.register("cooccurrence", "symbolic")(symbolic_triples)

Scorer = Callable[[list[tuple[str, str]]], list[float]]


@RELATIONS.register("nli", "entailment")
def by_entailment(sentences: DataFrame, mentions: DataFrame, scorer: Scorer, *, typed: float = 0.5, least: float = 0.0, hypotheses=HYPOTHESES) -> DataFrame:
    """Triples (doc_id, chunk_id, sujeto, relacion, objeto, confianza) from sentences (doc_id, chunk_id, n, texto) and
    mentions (chunk_id, n, entity).

    scorer gives the probability that a premise entails a hypothesis.  A directed pair takes the type of its best
    hypothesis; under typed it is COOCURRENCIA, under least it is left out.  Equal (sentence, subject, object) are
    scored once.
    """
    pairs = cooccurrence(mentions, ["chunk_id", "n"]).join(sentences, ["chunk_id", "n"]).withColumn("premise", entity_key(F.col("texto")))
    asked = pairs.groupBy("premise", "sujeto", "objeto").agg(F.min("texto").alias("texto"))

    @F.pandas_udf("struct<kind:string,score:double>")
    def best(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, s, o in batches:
            flat = scorer([(t, h.format(s=a, o=b)) for t, a, b in zip(text, s, o) for _, h in hypotheses])
            n = len(hypotheses)
            rows = [max((flat[i * n + j], -j) for j in range(n)) for i in range(len(text))]
            yield pd.DataFrame({"kind": [hypotheses[-j][0] for _, j in rows], "score": [round(float(x), 4) for x, _ in rows]})

    scored = asked.withColumn("b", best("texto", "sujeto", "objeto")).select("premise", "sujeto", "objeto", F.when(F.col("b.score") >= typed, F.col("b.kind")).otherwise("COOCURRENCIA").alias("relacion"), F.col("b.score").alias("confianza")).filter(F.col("confianza") >= least)
    out = pairs.select("doc_id", "chunk_id", "premise", "sujeto", "objeto").join(scored, ["premise", "sujeto", "objeto"])
    return out.groupBy("doc_id", "chunk_id", "sujeto", "relacion", "objeto").agg(F.max("confianza").alias("confianza"))


@RELATIONS.register("mrebel", "generation")
def by_generation(sentences: DataFrame, mentions: DataFrame, generate: Callable[[list[str]], list[str]], *, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Triples from generated triplet strings, one call a distinct sentence with two entities or more.

    Head and tail must be entities of the sentence and differ.  A phrase of the table gives its type with confidence
    0.9, any other RELACIONADO_CON with 0.7.
    """
    present = mentions.groupBy("chunk_id", "n").agg(F.collect_set("entity").alias("entities")).filter(F.size("entities") >= 2)
    ready = sentences.join(present, ["chunk_id", "n"]).withColumn("premise", entity_key(F.col("texto")))

    @F.pandas_udf("array<struct<sujeto:string,relacion:string,objeto:string,confianza:double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            out = []
            for made in generate(list(t)):
                rows = []
                for head, relation, tail in parse_triplets(made):
                    kind = phrases.get(key(relation))
                    rows.append({"sujeto": key(head), "relacion": kind or "RELACIONADO_CON", "objeto": key(tail), "confianza": 0.9 if kind else 0.7})
                out.append(rows)
            yield pd.Series(out)

    made = ready.groupBy("premise").agg(F.min("texto").alias("texto")).select("premise", F.explode(found("texto")).alias("t")).select("premise", "t.*")
    out = ready.select("doc_id", "chunk_id", "premise", "entities").join(made, "premise")
    kept = out.filter(F.array_contains("entities", F.col("sujeto")) & F.array_contains("entities", F.col("objeto")) & (F.col("sujeto") != F.col("objeto")))
    return kept.groupBy("doc_id", "chunk_id", "sujeto", "relacion", "objeto").agg(F.max("confianza").alias("confianza"))
