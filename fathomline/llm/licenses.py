"""Licence scans by sentence rules.  DataFrame functions only on the main path.

A text is cut into sentences; neighbouring sentences that together, normalised, are a known licence sentence become its
identifier; the document's identifier sequence is matched against ordered licence rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sentences of published licences that identify them, by name.  Wording is the licences' own.
SENTENCES = {
    "mit-short": "Released under the MIT License.",
    "mit-short-2": "Licensed under the MIT License.",
    "mit-short-3": "This project is licensed under the MIT License.",
    "mit-short-4": "This software is released under the MIT License.",
    "mit-title": "The MIT License (MIT).",
    "mit-title-2": "MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-title": "Apache License, Version 2.0.",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-short-2": "Licensed under the GNU General Public License, version 3.",
    "gpl2-short": "This work is licensed under the GNU General Public License, version 2.",
    "gpl2-short-2": "Licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl-short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-short": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-short": "Licensed under the BSD 3-Clause License.",
    "bsd2-short": "Licensed under the BSD 2-Clause License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-2": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-2": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc0": "Licensed under CC0 1.0.",
    "cc0-2": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

#: Ordered rules: (licence, sentences that must follow each other in this order).  Between two sentences of a rule
#: any text may stand, but no other licence sentence.  A sequence of sentences counts for the first rule that it matches
#: only, so longer rules stand before those that they begin with.
RULES = (
    ("Apache-2.0", ("apache-header", "apache-copy", "apache-warranty")), ("Apache-2.0", ("apache-header",)), ("Apache-2.0", ("apache-short",)), ("Apache-2.0", ("apache-title",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")), ("MIT", ("mit-grant", "mit-notice")), ("MIT", ("mit-short",)), ("MIT", ("mit-short-2",)), ("MIT", ("mit-short-3",)), ("MIT", ("mit-short-4",)), ("MIT", ("mit-title",)), ("MIT", ("mit-title-2",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")), ("BSD-3-Clause", ("bsd-short",)), ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")), ("BSD-2-Clause", ("bsd2-short",)),
    ("ISC", ("isc-grant",)), ("GPL-3.0-or-later", ("gpl-free",)), ("GPL-3.0-only", ("gpl3-short",)), ("GPL-3.0-only", ("gpl3-short-2",)), ("GPL-2.0-or-later", ("gpl2-free",)), ("GPL-2.0-only", ("gpl2-short",)), ("GPL-2.0-only", ("gpl2-short-2",)),
    ("LGPL-3.0-only", ("lgpl-short",)), ("AGPL-3.0-only", ("agpl-short",)), ("MPL-2.0", ("mpl-short",)),
    ("CC-BY-4.0", ("cc-by",)), ("CC-BY-4.0", ("cc-by-2",)), ("CC-BY-SA-4.0", ("cc-by-sa",)), ("CC-BY-SA-4.0", ("cc-by-sa-2",)), ("CC-BY-NC-4.0", ("cc-by-nc",)), ("CC-BY-NC-4.0", ("cc-by-nc-2",)), ("CC-BY-ND-4.0", ("cc-by-nd",)), ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC0-1.0", ("cc0",)), ("CC0-1.0", ("cc0-2",)), ("Unlicense", ("unlicense",)), ("all-rights-reserved", ("reserved",)),
)

#: A sentence ends at a line feed, or after . ! ? : ; and before a blank.
BOUNDARY = r"\n|(?<=[.!?:;])[ \t\r]+"
#: A text without these stems, in which a line may end within two words of one, holds no known sentence.
TEXT_STEMS = r"(?i)licen[sc]e|copyright|permission|warrant|redistribut|rights|public[^\p{L}\p{N}]+domain"


@dataclass(frozen=True)
class Rules:
    """Sentences and rules; a rule that names an unknown sentence, or that an earlier one always beats, is an error."""

    sentences: tuple[tuple[str, str], ...] = tuple(SENTENCES.items())
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES

    def __post_init__(self):
        names = {name for name, _ in self.sentences}
        for i, (licence, sequence) in enumerate(self.rules):
            if not sequence or (lacking := [x for x in sequence if x not in names]):
                raise ValueError(f"the rule of {licence} names unknown sentences: {', '.join(lacking) if sequence else 'none'}")
            if any(sequence[: len(before)] == before for _, before in self.rules[:i]):
                raise ValueError(f"the rule of {licence} on {', '.join(sequence)} can never match")


def normalised(sentence: Column) -> Column:
    """Lower case; runs of anything but letters, digits become one blank."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def _known(rules: Rules) -> dict[str, str]:
    return {re.sub(r"[\W_]+", " ", text.lower()).strip(): name for name, text in rules.sentences}


def _pattern(known: dict[str, str]) -> str:
    """Any known sentence in normalised pieces that have a line feed before and after each, wherever it is cut into pieces."""
    return r"\n(?:" + "|".join(k.replace(" ", r"(?: |\n\n)") for k in sorted(known, key=len, reverse=True)) + r")\n"


def _sequences(rules: Rules) -> dict[str, str]:
    """Sequences of identifiers, each between commas of its own, to licences."""
    return {"".join(f",{x}," for x in sequence): name for name, sequence in rules.rules}


def licenses(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: n_sentences, sentence_ids (known sentences in order, comma-joined), n_known, licenses.

    A known sentence may itself hold boundaries, and may be wrapped over lines with comment signs, so it is looked up
    over neighbouring sentences; where two begin at the same place the longer one counts.
    The identifier sequence is read from its start; at each place the first rule that matches takes its identifiers, so
    a sentence speaks for one licence.  licenses holds the licences found, in the order of the rules, without repeats,
    comma-joined; empty if there are none.  A null or empty text has no sentence and an empty sequence.  Repeated rows
    give repeated rows, an empty table an empty one, other columns aren't read.  The tables of sentences and rules are
    parameters of fixed size and go into the plan as literals: no join, no shuffle.
    """
    names, sequences = _known(rules), _sequences(rules)
    literal = lambda d: F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))
    known, licence = literal(names), literal(sequences)
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.filter(F.split(text, BOUNDARY), lambda s: F.length(F.trim(s)) > 0)
    # callers' own sentences may have no stem; then all texts are searched
    stemmed = all(re.search(r"licen[sc]e|copyright|permission|warrant|redistribut|rights|public domain", k) for k in names)
    asked = F.when(text.rlike(TEXT_STEMS), parts).otherwise(F.array().cast("array<string>")) if stemmed else parts
    cut = docs.select(F.col(id_col), F.size(parts).cast("long").alias("n_sentences"), F.array_join(F.filter(F.transform(asked, normalised), lambda s: s != ""), "\n\n").alias("_s"))
    hits = F.regexp_extract_all(F.concat(F.lit("\n"), "_s", F.lit("\n")), F.lit(_pattern(names)), F.lit(0))
    ids = F.transform(hits, lambda s: known[F.replace(F.trim(F.translate(s, "\n", " ")), F.lit("  "), F.lit(" "))])
    found = cut.select(id_col, "n_sentences", F.array_join(ids, ",").alias("sentence_ids"), F.size(ids).cast("long").alias("n_known"))
    padded = F.concat(F.lit(","), F.replace(F.col("sentence_ids"), F.lit(","), F.lit(",,")), F.lit(","))
    matched = F.transform(F.regexp_extract_all(padded, F.lit("|".join(sequences)), F.lit(0)), lambda s: licence[s])
    ordered = F.filter(F.array(*[F.lit(x) for x in dict.fromkeys(sequences.values())]), lambda x: F.array_contains(matched, x))
    return found.select(id_col, "n_sentences", "sentence_ids", "n_known", F.when(F.col("n_known") == 0, F.lit("")).otherwise(F.array_join(ordered, ",")).alias("licenses"))


def oracle_sql(rules: Rules = Rules()) -> str:
    """The same in DuckDB SQL, from the same tables of sentences and rules."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    names, sequences = _known(rules), _sequences(rules)
    literal = lambda d: "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in d.items()) + "}"
    order = ", ".join(quote(x) for x in dict.fromkeys(sequences.values()))
    return f"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?:;])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)), lambda s: length(trim(s, ' ')) > 0) AS parts FROM documents
), norm AS (
  SELECT doc_id, len(parts) AS n_sentences, chr(10) || array_to_string(list_filter(list_transform(parts, lambda s: trim(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))), lambda s: s <> ''), chr(10) || chr(10)) || chr(10) AS s FROM cut
), ids AS (
  SELECT doc_id, n_sentences, list_transform(CASE WHEN regexp_matches(s, 'licen[sc]e|copyright|permission|warrant|redistribut|rights|public[^\\p{{L}}\\p{{N}}]+domain') THEN regexp_extract_all(s, {quote(_pattern(names))}) ELSE [] END, lambda x: {literal(names)}[replace(trim(replace(x, chr(10), ' ')), '  ', ' ')]) AS ids FROM norm
), joined AS (
  SELECT doc_id, n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, len(ids) AS n_known, list_transform(regexp_extract_all(',' || replace(coalesce(array_to_string(ids, ','), ''), ',', ',,') || ',', {quote("|".join(sequences))}), lambda x: {literal(sequences)}[x]) AS found FROM ids
)
SELECT doc_id, n_sentences::BIGINT AS n_sentences, sentence_ids, n_known::BIGINT AS n_known,
  CASE WHEN n_known = 0 THEN '' ELSE coalesce(array_to_string(list_filter([{order}], lambda x: list_contains(found, x)), ','), '') END AS licenses
FROM joined"""
