"""Entity recognition with a vocabulary table, and a parser of generated triplets."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.registry import Registry
from fathomline.session import small_batches

EXTRACTORS: Registry = Registry("entity extractor")

#: Fixed values: (form, type, canonical form).  Users pass a table of their own in the same shape.
VOCABULARY = (
    ("NASA", "ORGANIZACION", "nasa"), ("ESA", "ORGANIZACION", "esa"), ("Agencia Espacial Europea", "ORGANIZACION", "esa"), ("European Space Agency", "ORGANIZACION", "esa"), ("JAXA", "ORGANIZACION", "jaxa"), ("Roscosmos", "ORGANIZACION", "roscosmos"), ("SpaceX", "ORGANIZACION", "spacex"), ("Blue Origin", "ORGANIZACION", "blue origin"),
    ("ONU", "ORGANIZACION", "onu"), ("Naciones Unidas", "ORGANIZACION", "onu"), ("United Nations", "ORGANIZACION", "onu"), ("OTAN", "ORGANIZACION", "otan"), ("NATO", "ORGANIZACION", "otan"), ("Unión Europea", "ORGANIZACION", "union europea"), ("European Union", "ORGANIZACION", "union europea"), ("OCDE", "ORGANIZACION", "ocde"), ("OECD", "ORGANIZACION", "ocde"), ("UNESCO", "ORGANIZACION", "unesco"),
    ("Estados Unidos", "PAIS", "estados unidos"), ("United States", "PAIS", "estados unidos"), ("China", "PAIS", "china"), ("Rusia", "PAIS", "rusia"), ("Russia", "PAIS", "rusia"), ("Colombia", "PAIS", "colombia"), ("Brasil", "PAIS", "brasil"), ("Brazil", "PAIS", "brasil"), ("India", "PAIS", "india"), ("Japón", "PAIS", "japon"), ("Japan", "PAIS", "japon"), ("Ucrania", "PAIS", "ucrania"), ("Ukraine", "PAIS", "ucrania"),
    ("América Latina", "REGION", "america latina"), ("Latin America", "REGION", "america latina"), ("Europa", "REGION", "europa"), ("Europe", "REGION", "europa"), ("Asia", "REGION", "asia"), ("África", "REGION", "africa"), ("Africa", "REGION", "africa"),
    ("Programa Artemisa", "PROGRAMA", "programa artemisa"), ("Artemis", "PROGRAMA", "programa artemisa"), ("Copernicus", "PROGRAMA", "copernicus"), ("Galileo", "PROGRAMA", "galileo"),
    ("inteligencia artificial", "TECNOLOGIA", "inteligencia artificial"), ("artificial intelligence", "TECNOLOGIA", "inteligencia artificial"), ("aprendizaje automático", "TECNOLOGIA", "aprendizaje automatico"), ("machine learning", "TECNOLOGIA", "aprendizaje automatico"), ("satélite", "TECNOLOGIA", "satelite"), ("satellite", "TECNOLOGIA", "satelite"), ("satellites", "TECNOLOGIA", "satelite"), ("blockchain", "TECNOLOGIA", "blockchain"),
    ("Tratado del Espacio Exterior", "TRATADO", "tratado del espacio exterior"), ("Outer Space Treaty", "TRATADO", "tratado del espacio exterior"), ("Acuerdo de París", "TRATADO", "acuerdo de paris"), ("Paris Agreement", "TRATADO", "acuerdo de paris"),
    ("cambio climático", "EVENTO", "cambio climatico"), ("climate change", "EVENTO", "cambio climatico"), ("ciberseguridad", "SECTOR", "ciberseguridad"), ("cybersecurity", "SECTOR", "ciberseguridad"), ("defensa", "SECTOR", "defensa"), ("agricultura", "SECTOR", "agricultura"), ("agriculture", "SECTOR", "agricultura"),
)

#: Forms in another language or spelling, normalised, and the id that they stand for.
ALIASES = {
    "space debris": "basura espacial", "orbital debris": "basura espacial", "space junk": "basura espacial", "international space station": "estacion espacial internacional", "low earth orbit": "orbita terrestre baja", "leo": "orbita terrestre baja", "geostationary orbit": "orbita geoestacionaria",
    "artificial intelligence": "inteligencia artificial", "ai": "inteligencia artificial", "ia": "inteligencia artificial", "machine learning": "aprendizaje automatico", "deep learning": "aprendizaje profundo", "natural language processing": "procesamiento de lenguaje natural", "computer vision": "vision por computador", "internet of things": "internet de las cosas",
    "large language models": "modelos de lenguaje", "language models": "modelos de lenguaje", "foundation models": "modelos fundacionales", "digital twins": "gemelos digitales", "quantum computing": "computacion cuantica", "cloud computing": "computacion en la nube", "chatbots": "chatbot", "virtual assistants": "asistentes virtuales",
    "satellite": "satelite", "satellites": "satelite", "nanosatellite": "nanosatelite", "united states": "estados unidos", "usa": "estados unidos", "united nations": "organizacion de las naciones unidas", "latin america": "america latina", "central america": "centroamerica", "the caribbean": "el caribe", "antarctica": "antartida", "south korea": "corea del sur", "united arab emirates": "emiratos arabes unidos", "european union": "union europea", "nato": "otan",
    "mexican space agency": "agencia espacial mexicana", "brazilian space agency": "agencia espacial brasilena", "european space agency": "agencia espacial europea", "national aeronautics and space administration": "nasa", "space agencies": "agencias espaciales", "artemis program": "programa artemisa", "artemis accords": "acuerdos artemisa", "outer space treaty": "tratado del espacio ultraterrestre", "satellite constellation": "constelacion de satelites",
    "space security": "seguridad espacial", "national security": "seguridad nacional", "cybersecurity": "ciberseguridad", "cyber attacks": "ataques ciberneticos", "cyberwarfare": "ciberguerra", "electronic warfare": "guerra electronica", "hybrid warfare": "guerra hibrida", "information warfare": "guerra de informacion", "signal interference": "interferencia de senales", "digital sovereignty": "soberania digital", "space sovereignty": "soberania espacial", "military intelligence": "inteligencia militar", "satellite surveillance": "vigilancia satelital", "satellite reconnaissance": "reconocimiento satelital",
    "remote sensing": "teleobservacion", "synthetic aperture radar": "radar de apertura sintetica", "unmanned aerial vehicles": "vehiculos aereos no tripulados", "global positioning system": "gps",
}

#: Words that a run of capitalised words may neither begin nor end with.
FUNCTION_WORDS = frozenset("el la los las un una unos unas de del en con por para sobre entre y o e u que al a se su sus como tras durante desde hasta según the of an and in on with for to from is are".split())

#: Two or more capitalised words of three letters or more.
_CAPITAL = re.compile(r"\b(?:[A-ZÁÉÍÓÚÑ][a-záéíóúñ]{2,}\s+)+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]{2,}\b")


def key(name: str) -> str:
    """Canonical id of a name: compatibility forms, no accents, no punctuation, lower case, single blanks."""
    if name.isascii() and name.isalnum():
        return name.lower()
    flat = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^\w\s]", " ", flat).lower().split())


_TOKEN = re.compile(r"\w+")
_token_key = lru_cache(1 << 15)(key)  # texts repeat their words


@dataclass
class Gazetteer:
    """Whole-word lookup of normalised forms: longer forms first, matches don't overlap.  With proper_nouns, runs of two
    or more capitalised words that no form covers become entities of type OTRO, without function words at their ends.  Ids
    are canonical: an alias stands for the id that it is an alias of.  A caller's own forms are further rows."""

    vocabulary: tuple[tuple[str, str, str], ...] = VOCABULARY
    proper_nouns: bool = True
    aliases: dict[str, str] = field(default_factory=lambda: ALIASES)
    _forms: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __post_init__(self):
        for form, kind, canonical in self.vocabulary:
            own = key(canonical)
            self._forms[key(form)] = (kind, self.aliases.get(key(form), self.aliases.get(own, own)))
        self._longest = max((len(f.split()) for f in self._forms), default=0)
        # how many words the forms with a first word have; a token's key may hold several words, and the first counts
        self._lengths: dict[str, set[int]] = {}
        for f in self._forms:
            self._lengths.setdefault(f.split(" ", 1)[0], set()).update(range(1, max(1, len(f.split())) + 1))

    def find(self, text: str) -> list[tuple[int, str, str, str]]:
        """(start, id, type, surface form) in the order of the text."""
        tokens = [(m.start(), m.end(), _token_key(m.group())) for m in _TOKEN.finditer(text)]
        begins: dict[int, list[int]] = {}  # by number of tokens, where a form of so many may begin
        for i, t in enumerate(tokens):
            for n in self._lengths.get(t[2].split(" ", 1)[0], ()):
                begins.setdefault(n, []).append(i)
        used = [False] * len(tokens)
        out = []
        for n in range(self._longest, 0, -1):
            for i in begins.get(n, ()):
                if i + n > len(tokens) or any(used[i : i + n]):
                    continue
                hit = self._forms.get(" ".join(t[2] for t in tokens[i : i + n]))
                if hit and not re.search(r"[.!?\n]", text[tokens[i][0] : tokens[i + n - 1][1]]):
                    used[i : i + n] = [True] * n
                    out.append((tokens[i][0], hit[1], hit[0], text[tokens[i][0] : tokens[i + n - 1][1]]))
        if self.proper_nouns:
            taken = [(a, b) for (a, b, _), u in zip(tokens, used) if u]
            for m in _CAPITAL.finditer(text):
                words = [*re.finditer(r"\S+", m.group())]
                while words and words[0].group().lower() in FUNCTION_WORDS:
                    del words[0]
                while words and words[-1].group().lower() in FUNCTION_WORDS:
                    del words[-1]
                if len(words) < 2:
                    continue
                a, b = m.start() + words[0].start(), m.start() + words[-1].end()
                if not any(s < b and a < e for s, e in taken):
                    own = key(text[a:b])
                    out.append((a, self.aliases.get(own, own), "OTRO", text[a:b]))
        return sorted(out)


EXTRACTORS.register("gazetteer", "regex")(Gazetteer)


def mentions(chunks: DataFrame, vocabulary: tuple[tuple[str, str, str], ...] = VOCABULARY, *, proper_nouns: bool = True, id_col: str = "chunk_id", text_col: str = "texto") -> DataFrame:
    """(chunk id, position, id, tipo, nombre) of each mention in each text; null texts have none."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Gazetteer(tuple(vocabulary), proper_nouns)
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(1)):
                found = g.find(t.as_py() or "")
                at += [i] * len(found)
                rows += found
            columns = [*zip(*rows)] or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(columns[c], k) for c, k in ((0, pa.int64()), (1, pa.string()), (2, pa.string()), (3, pa.string())))], names=[id_col, "position", "id", "tipo", "nombre"])

    df = small_batches(chunks.select(id_col, text_col))
    return df.mapInArrow(find, f"`{id_col}` {df.schema[0].dataType.simpleString()}, position bigint, id string, tipo string, nombre string")


def present(sentence: Column, forms: Column) -> Column:
    """Whether any of the forms (an array of names) stands in a sentence as whole words, both sides normalised."""
    own = F.concat(F.lit(" "), text.entity_key(sentence), F.lit(" "))
    return F.exists(forms, lambda f: (text.entity_key(f) != "") & own.contains(F.concat(F.lit(" "), text.entity_key(f), F.lit(" "))))


def parse_triplets(generated: str) -> list[tuple[str, str, str]]:
    """(head, relation, tail) of a generated string `<triplet> head <subj> tail <obj> relation`; in the typed form,
    markers such as <per> stand in place of <subj> and <obj>.  Incomplete triplets are left out, repeats kept once."""
    out: list[tuple[str, str, str]] = []
    text = re.sub(r"</?s>|<pad>|tp_XX|__\w+__", " ", generated)
    for block in text.split("<triplet>")[1:]:
        parts = [p.strip() for p in re.split(r"<[a-z]+>", block)]
        head = parts[0]
        for tail, relation in zip(parts[1::2], parts[2::2]):
            if head and tail and relation and (head, relation, tail) not in out:
                out.append((head, relation, tail))
    return out
