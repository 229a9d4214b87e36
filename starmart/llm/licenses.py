"""Licences recognised by the sequence of their sentences."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences, by identifier: lower case words and numbers, single blanks.
SENTENCES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "apache-2.0-terms": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies",
    "as-is": "the software is provided as is without warranty of any kind",
    "gpl-3.0-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "bsd-redistribution": "redistribution and use in source and binary forms are permitted",
    "cc-by-nc-4.0-notice": "licensed under cc by nc 4 0",
    "cc-by-4.0-notice": "licensed under cc by 4 0",
    "cc0-notice": "to the extent possible under law the author has waived all copyright",
    "rights-reserved": "all rights reserved",
    # Published sentences, whole.
    "apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use this file"
    " except in compliance with the license",
    "apache-2.0-header-asf": "the asf licenses this file to you under the apache license version 2 0 the license"
    " you may not use this file except in compliance with the license",
    "apache-2.0-title": "apache license version 2 0 january 2004",
    "mit-grant-whole": "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction including without"
    " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
    " and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition-whole": "the above copyright notice and this permission notice shall be included in all copies"
    " or substantial portions of the software",
    "mit-condition-next": "the above copyright notice and this permission notice including the next paragraph shall be"
    " included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not"
    " limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-redistribution-whole": "redistribution and use in source and binary forms with or without modification are"
    " permitted provided that the following conditions are met",
    **{
        f"bsd-as-is-{i}": f"this software is provided by the {who} as is and any express or implied warranties including"
        " but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
        for i, who in enumerate(
            (
                "copyright holders and contributors",
                "copyright holder and contributors",
                "regents and contributors",
                "author and contributors",
                "authors and contributors",
                "author",
            )
        )
    },
    "gpl-2.0-terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation either version 2 of the license or at your"
    " option any later version",
    "gpl-3.0-terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version",
    "gpl-warranty-whole": "this program is distributed in the hope that it will be useful but without any warranty"
    " without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-2.0-title": "gnu general public license version 2 june 1991",
    "gpl-3.0-title": "gnu general public license version 3 29 june 2007",
}

# Each rule is a licence and the sentences that must follow each other, others between them allowed.
RULES = (
    ("Apache-2.0", ("apache-2.0-notice",)),
    ("Apache-2.0", ("apache-2.0-terms", "apache-2.0-copy")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("GPL-3.0", ("gpl-3.0-notice",)),
    ("GPL", ("gpl-free", "gpl-terms", "gpl-warranty")),
    ("BSD", ("bsd-redistribution", "as-is")),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-notice",)),
    ("CC-BY-4.0", ("cc-by-4.0-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("All-Rights-Reserved", ("rights-reserved",)),
    ("Apache-2.0", ("apache-2.0-header",)),
    ("Apache-2.0", ("apache-2.0-header-asf",)),
    ("Apache-2.0", ("apache-2.0-title",)),
    ("MIT", ("mit-grant-whole", "mit-condition-whole", "mit-as-is")),
    ("MIT", ("mit-grant-whole", "mit-condition-next", "mit-as-is")),
    *(("BSD", ("bsd-redistribution-whole", i)) for i in SENTENCES if i.startswith("bsd-as-is-")),
    ("GPL-2.0", ("gpl-2.0-terms", "gpl-warranty-whole")),
    ("GPL-3.0", ("gpl-3.0-terms", "gpl-warranty-whole")),
    ("GPL-2.0", ("gpl-2.0-title",)),
    ("GPL-3.0", ("gpl-3.0-title",)),
)

# A sentence ends with . ! or ? before white space, or with a line without letters A-Z and digits;
# of one on several lines each run of whole lines is a candidate, single line breaks read as blanks.
_END = r"(?<=[.!?])[ \t\r\n]+"


def _lines(text: Column) -> Column:
    """Lines of words in lower case, other signs than A-Z and digits as one blank; an empty line ends a sentence."""
    words = F.regexp_replace(F.regexp_replace(text, _END, "\n\n"), r"[^A-Za-z0-9\n]+", " ")
    return F.lower(F.regexp_replace(words, r" ?\n ?|^ | \z", "\n"))


def _pattern(sentences: Iterable[str]) -> str:
    """Any of ``sentences`` on whole lines, the longest first; a blank may be a line break."""
    longest = sorted(sentences, key=lambda s: (-len(s), s))
    return r"(?<=\n|\A)(?:" + "|".join(s.replace(" ", r"[ \n]") for s in longest) + r")(?=\n|\z)"


def _follow(ids: Column, rule: Sequence[str]) -> Column:
    """Whether the rule's sentences stand among ``ids`` in this order."""
    done = F.aggregate(
        ids,
        F.lit(0),
        lambda n, x: F.when(x == F.get(F.array(*map(F.lit, rule)), n), n + 1).otherwise(n),
    )
    return done == len(rule)


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
) -> DataFrame:
    """``doc_id, sentences, licenses`` for every row: identifiers of the known sentences
    of the whole text in their order, repeats included, and the licences of all
    rules that these fulfil, sorted, each once.

    NULL and empty texts have neither. A projection over one scan, all built-in
    expressions: no shuffle, and rows depend on themselves alone. The tables of
    sentences and rules are parameters and travel with the plan.
    """
    table = F.create_map(*[F.lit(x) for i, s in sentences.items() for x in (s, i)])
    lines = _lines(F.coalesce(F.col(text), F.lit("")))
    parts = F.regexp_extract_all(lines, F.lit(_pattern(sentences.values())), F.lit(0))
    ids = F.transform(parts, lambda s: F.element_at(table, F.translate(s, "\n", " ")))
    found = docs.select(F.col(doc_id).alias("doc_id"), ids.alias("sentences"))
    met = F.array(*[F.when(_follow(F.col("sentences"), rule), F.lit(name)) for name, rule in rules])
    licenses = F.array_sort(F.array_distinct(F.array_compact(met)))
    none = F.array().cast("array<string>")
    return found.select("doc_id", "sentences", F.when(F.size("sentences") > 0, licenses).otherwise(none).alias("licenses"))
