"""Knowledge graph on two tables: entities (id, nombre, tipo, variantes) and triples (sujeto, relacion, objeto, doc_id,
chunk_id, evidencia, confianza).  Triples are a multigraph: they are never made distinct before they are counted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.functions.text import entity_key

#: Rows that one task gathers, sorts or adds up at a time; some 200 bytes each in memory.
TASK_ROWS = 2_000_000

#: Values that one start's list holds; where a start has more, all lists are dealt into parts by their values' hash.
LIST_ROWS = 100_000

#: Entities that are broadcast at most, to leave out the links of others.
FEW = 100_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt by keys to as many tasks as rows ask for, whatever the session's number of partitions is; adaptive
    execution doesn't join these again, as it does by the size of compressed rows.  A table of few rows stays."""
    n = -(-rows // TASK_ROWS)
    return df if n < 2 else df.repartition(n, *keys)


def touches(triples: DataFrame) -> DataFrame:
    """(entity, doc_id, chunk_id, ...): a row for each end of each triple; a loop has two."""
    return triples.withColumn("entity", F.explode(F.array("sujeto", "objeto")))


def edges(triples: DataFrame) -> DataFrame:
    """(a, b): distinct undirected adjacency, both ways, without loops."""
    pairs = triples.select(F.col("sujeto").alias("a"), F.col("objeto").alias("b")).filter("a <> b")
    return pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def links(triples: DataFrame) -> DataFrame:
    """(entity, value): for each end of each triple the other end, without loops; triples are read once."""
    ends = F.array(F.struct(F.col("sujeto").alias("entity"), F.col("objeto").alias("value")), F.struct(F.col("objeto").alias("entity"), F.col("sujeto").alias("value")))
    return triples.filter("sujeto <> objeto").select(F.explode(ends).alias("x")).select("x.entity", "x.value")


def near(triples: DataFrame, nodes: DataFrame, keys: list[str], entity: str = "entity") -> DataFrame:
    """(keys, b): the distinct neighbours of the nodes (keys, entity), without the node itself.

    Only triples with an end among the nodes are followed, so what is shuffled grows with the nodes' degrees and not
    with the graph; Spark broadcasts the nodes where their size allows.
    """
    ends = links(triples).select(F.col("entity").alias(entity), F.col("value").alias("b"))
    return ends.join(nodes.select(*dict.fromkeys([*keys, entity])), entity).select(*keys, "b").distinct()


def gathered(nodes: DataFrame, values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(start, value): for each start the distinct values (entity, value) of its nodes (start, entity), without what is
    known (start, value) already.  The nodes are read by two jobs.

    An entity's values go to each of its starts as one list, so a row is moved for each node and not for each value that
    it brings, and values are made distinct within their start's lists.  No list is longer than LIST_ROWS by much: the
    values are counted before, and where a start has more, each part of the values has lists of its own.
    """
    size = values.groupBy("entity").agg(F.count("*").alias("n"))
    brought = size.join(nodes, "entity", "left").groupBy("start").agg(F.sum("n").alias("n"), F.max("n").alias("longest"), F.count("start").alias("nodes"))
    own = F.when(F.col("start").isNotNull(), F.col("n"))
    most, rows, n_nodes, longest = brought.agg(*(F.coalesce(x, F.lit(0)) for x in (F.max(own), F.sum(own), F.sum("nodes"), F.max("longest")))).first()
    # lists of entities that no start asks for are made too, unless the asked ones are few
    parts = max(1, -(-(most if n_nodes <= FEW else max(most, longest)) // LIST_ROWS))
    part = F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int").alias("part")
    if n_nodes <= FEW:
        values = values.join(F.broadcast(nodes.select("entity").distinct()), "entity", "left_semi")
    # collect_set leaves nulls out
    null = F.array(F.lit(None).cast(values.schema["value"].dataType))
    lists = values.groupBy("entity", part).agg(F.collect_set("value").alias("values"), F.max(F.col("value").isNull()).alias("has_null"))
    lists = lists.withColumn("values", F.when(F.col("has_null"), F.concat("values", null)).otherwise(F.col("values"))).drop("has_null")
    asked = nodes.select("start", "entity", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    found = asked.join(lists, ["entity", "part"]).select("start", "part", "values")
    if known is None:
        own = spread(found, rows, "start", "part").groupBy("start", "part").agg(F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"))
    else:
        kind = lists.schema["values"].dataType
        old = known.select("start", part, F.lit(None).cast(kind).alias("values"), F.col("value").alias("old"))
        both = found.withColumn("old", F.lit(None).cast(kind.elementType)).unionByName(old)
        own = spread(both, rows, "start", "part").groupBy("start", "part").agg(F.array_except(F.flatten(F.collect_list("values")), F.collect_list("old")).alias("values"))
    return own.select("start", F.explode("values").alias("value"))


def degree(triples: DataFrame) -> DataFrame:
    """(entity, n_triples, n_neighbours)."""
    near = edges(triples).groupBy(F.col("a").alias("entity")).agg(F.count("*").alias("n_neighbours"))
    return touches(triples).groupBy("entity").agg(F.count("*").alias("n_triples")).join(near, "entity", "left").withColumn("n_neighbours", F.coalesce("n_neighbours", F.lit(0)))


def neighbours(triples: DataFrame, starts: DataFrame, depth: int = 1, stored: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(start, entity, distance) of all entities within depth steps of starts(start), without the start; breadth first,
    one join a step, each entity at its smallest distance.  The first step goes by rows, as each start is one node of its
    own; later ones go by lists.  stored keeps a table that several jobs read; without it each job makes its own."""
    own = starts.select("start", F.col("start").alias("entity"), F.lit(0).alias("distance")).distinct()
    seen, front = own, own
    for d in range(1, depth + 1):
        if d > 1 and stored:
            front = stored(front)
            seen = before.unionAll(front)
        if d == 1:
            reached = near(triples, front, ["start"]).select("start", F.col("b").alias("value"))
        else:
            reached = gathered(front.select("start", "entity"), links(triples), seen.select("start", F.col("entity").alias("value")))
        front = reached.select("start", F.col("value").alias("entity"), F.lit(d).alias("distance"))
        before, seen = seen, seen.unionAll(front)
    return seen.filter("distance > 0")


def weights(triples: DataFrame, query_entities: DataFrame) -> DataFrame:
    """(query_id, entity, w): 1 for a query's entities (query_id, entity), and 0.5 for each of them that an entity is a
    direct neighbour of; both add up."""
    asked = query_entities.select("query_id", "entity").distinct()
    pairs = near(triples, asked.withColumn("own", F.col("entity")), ["query_id", "own"]).select("query_id", F.col("b").alias("entity"), F.lit(0.5).alias("w"))
    return asked.select("query_id", "entity", F.lit(1.0).alias("w")).unionAll(pairs).groupBy("query_id", "entity").agg(F.sum("w").alias("w"))


def scored_rows(triples: DataFrame, query_entities: DataFrame) -> int:
    """How many rows the evidence of all queries adds up: the degrees of their entities and these' neighbours.  A triple
    that touches a query's entity counts once for it, and its other end's degree once a query and neighbour."""
    size = touches(triples).groupBy("entity").agg(F.count("*").alias("n"))
    return weights(triples, query_entities).join(size, "entity").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def evidence(triples: DataFrame, query_entities: DataFrame, k: int | None = None) -> DataFrame:
    """(query_id, chunk_id, doc_id, score, rank): chunks by the graph evidence for a query's entities (query_id, entity).

    Each triple that touches a query entity counts 1; each that touches one of its direct neighbours counts 0.5.
    """
    weighted = weights(triples, query_entities)
    n = scored_rows(triples, query_entities)
    scored = None
    for end in ("sujeto", "objeto"):
        part = triples.select(F.col(end).alias("entity"), "chunk_id", "doc_id").join(weighted, "entity").select("query_id", "chunk_id", "doc_id", "w")
        scored = part if scored is None else scored.unionAll(part)
    scored = spread(scored, n, "query_id", "chunk_id").groupBy("query_id", "chunk_id").agg(F.sum("w").alias("score"), F.max("doc_id").alias("doc_id"))
    out = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")))
    return out if k is None else out.filter(F.col("rank") <= max(1, k))


def explanation(triples: DataFrame, query_entities: DataFrame, targets: DataFrame, most: int = 10) -> DataFrame:
    """(query_id, chunk_id, sujeto, relacion, objeto, confianza, place): for each target chunk of a query, its triples
    with an end in the query's entities or their neighbours; best confidence first, at most `most` (a report's limit)."""
    relevant = weights(triples, query_entities).select("query_id", "entity")
    own = targets.select("query_id", "chunk_id").distinct().join(triples, "chunk_id").withColumn("entity", F.explode(F.array_distinct(F.array("sujeto", "objeto"))))
    kept = own.join(relevant, ["query_id", "entity"], "left_semi").drop("entity").groupBy("query_id", "chunk_id", "sujeto", "relacion", "objeto").agg(F.max("confianza").alias("confianza"))
    w = Window.partitionBy("query_id", "chunk_id").orderBy(F.desc("confianza"), "sujeto", "relacion", "objeto")
    return kept.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def paths(triples: DataFrame, query_entities: DataFrame, targets: DataFrame, *, most: int = 10, most_triples: int = 100, most_chunks: int = 50) -> DataFrame:
    """A row a query: entities, neighbours (sorted), triples around the entities (a report's most_triples with the most
    evidence), evidence_chunks (its most_chunks best), and chunks: for each target chunk its explaining triples and
    whether it has any (aporto)."""
    asked = query_entities.select("query_id", "entity").distinct()
    own = asked.groupBy("query_id").agg(F.array_sort(F.collect_set("entity")).alias("entities"))
    around = near(triples, asked, ["query_id"]).groupBy("query_id").agg(F.array_sort(F.collect_set("b")).alias("neighbours"))
    touching = triples.withColumn("entity", F.explode(F.array_distinct(F.array("sujeto", "objeto")))).join(asked, "entity")
    counted = touching.groupBy("query_id", "sujeto", "relacion", "objeto").agg(F.countDistinct("chunk_id").alias("n"), F.max("confianza").alias("confianza"))
    top = counted.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("n"), F.desc("confianza"), "sujeto", "relacion", "objeto"))).filter(F.col("r") <= most_triples)
    listed = top.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "sujeto", "relacion", "objeto", "n"))), lambda x: x.dropFields("r")).alias("triples"))
    best = evidence(triples, query_entities, most_chunks).groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "score"))), lambda x: x.dropFields("rank")).alias("evidence_chunks"))
    found = explanation(triples, query_entities, targets, most).groupBy("query_id", "chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sujeto", "relacion", "objeto", "confianza"))), lambda x: x.dropFields("place")).alias("triples"))
    asked_for = targets.select("query_id", "chunk_id").distinct().join(found, ["query_id", "chunk_id"], "left")
    chunks = asked_for.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("chunk_id", F.col("triples").isNotNull().alias("aporto"), "triples"))).alias("chunks"))
    return own.join(around, "query_id", "left").join(listed, "query_id", "left").join(best, "query_id", "left").join(chunks, "query_id", "full_outer")


def merged_entities(mentions: DataFrame) -> DataFrame:
    """entities of mentions (id, nombre, tipo, position): name and type of the first mention, all names as variants, each
    once, in the order in which they first occur."""
    named = mentions.groupBy("id", "nombre").agg(F.min(F.struct("position", "tipo")).alias("m"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("m.position").alias("position"), "nombre", F.col("m.tipo").alias("tipo"))))
    return named.groupBy("id").agg(listed.alias("v")).select("id", F.col("v")[0]["nombre"].alias("nombre"), F.col("v")[0]["tipo"].alias("tipo"), F.transform("v", lambda x: x["nombre"]).alias("variantes"))


def last_written(entities: DataFrame, ordinal: str) -> DataFrame:
    """One row an id, that of the largest ordinal."""
    return entities.groupBy("id").agg(F.max_by(F.struct(*(c for c in entities.columns if c != "id")), ordinal).alias("e")).select("id", "e.*")


def orphans(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """Ends of triples that are no entity; a graph is whole if there is none."""
    return touches(triples).select("entity").distinct().join(entities.select(F.col("id").alias("entity")), "entity", "left_anti")


def materialised(triples: DataFrame, entities: DataFrame) -> DataFrame:
    """Triples with both ends among the entities."""
    ids = entities.select(F.col("id"))
    out = triples
    for end in ("sujeto", "objeto"):
        out = out.join(ids, out[end] == ids["id"], "left_semi")
    return out


#: Relation types and the patterns, in order, that show them in a normalised sentence.
VERBS = (
    ("UBICADO_EN", ("ubicado en", "ubicada en", "ubicados en", "ubicadas en", "situado en", "situada en", "se encuentra en", "se encuentran en", "localizado en", "localizada en", "located in", "based in")),
    ("ES_PARTE_DE", ("es parte de", "forma parte de", "es miembro de", "part of", "member of")),
    ("PARTE_DE", ("parte de", "miembro de")),
    ("PERTENECE_A", ("pertenece a", "pertenecen a", "es propiedad de", "son propiedad de", "belongs to", "owned by")),
    ("AFECTA", ("afecta a", "afectan a", "impacta a", "impactan a", "incide en", "inciden en", "influye en", "influyen en", "amenaza a", "amenazan a", "threatens", "impacts")),
    ("CAUSA", ("causa", "causan", "provoca", "provocan", "genera", "generan", "origina", "causes", "triggers")),
    ("DEPENDE_DE", ("depende de", "dependen de", "depende de la", "depende del", "depends on")),
    ("COOPERA_CON", ("coopera con", "cooperan con", "colabora con", "colaboran con", "trabaja junto a", "trabaja junto con", "es aliado de", "es aliada de", "cooperates with", "collaborates with", "partnership with")),
    ("OPONE_A", ("se opone a", "se enfrenta a", "en conflicto con", "rival de", "opposes", "conflict with")),
    ("INVOLUCRA", ("involucra", "involucran", "incluye", "incluyen", "comprende", "comprenden", "involves", "includes")),
    ("RELACIONADO_CON", ("relacionado con", "relacionada con", "relacionados con", "relacionadas con", "vinculado a", "vinculada a", "asociado a", "asociada a", "related to", "linked to", "associated with")),
)


def relation_of(sentence: Column, verbs=VERBS) -> Column:
    """Type of the first group with a pattern in the normalised sentence (no accents, no punctuation, lower case), else
    COOCURRENCIA.  Patterns are found within words too."""
    out = None
    for kind, stems in verbs:
        hit = entity_key(sentence).rlike("|".join(stems))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("COOCURRENCIA")


def cooccurrence(mentions: DataFrame, sentence: list[str], entity: str = "entity") -> DataFrame:
    """(sentence, sujeto, objeto): each two different entities of a sentence, both ways.  The join is on the sentence,
    so its size is bounded by sentences, which are short."""
    own = mentions.select(*sentence, F.col(entity).alias("sujeto")).distinct()
    return own.join(own.withColumnRenamed("sujeto", "objeto"), sentence).filter("sujeto <> objeto")


def symbolic_triples(sentences: DataFrame, mentions: DataFrame) -> DataFrame:
    """Triples from sentences (doc_id, chunk_id, n, texto) and mentions (chunk_id, n, entity): type by verb, confidence
    0.9 with a verb and 0.6 without, the best of equal triples of a chunk."""
    # the type is the sentence's: found once for each, before pairs multiply it
    typed = sentences.select("doc_id", "chunk_id", "n", relation_of(F.col("texto")).alias("relacion"))
    pairs = cooccurrence(mentions, ["chunk_id", "n"]).join(typed, ["chunk_id", "n"])
    found = pairs.withColumn("confianza", F.when(F.col("relacion") == "COOCURRENCIA", 0.6).otherwise(0.9))
    return found.groupBy("doc_id", "chunk_id", "sujeto", "relacion", "objeto").agg(F.max("confianza").alias("confianza"))
