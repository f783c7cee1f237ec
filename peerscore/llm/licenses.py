"""Licence scan by sentence rules, from SQL functions only.

Texts are cut into sentences, sentences are normalised and looked up among
known licence sentences, and the sequence of identifiers found is matched
against ordered rules, longest first.  Known texts are cut by the same marks as
the documents, so a sentence with a colon or semicolon inside is a sequence of
identifiers like any other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names licences go by, as normalised text.
_NAMES = {
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "MIT": ("mit license", "mit licence", "expat license"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "CC0-1.0": ("cc0 1 0", "cc0 1 0 universal", "creative commons zero"),
    "Unlicense": ("unlicense",),
}
_GNU = {"GPL": "gnu general public license", "LGPL": "gnu lesser general public license", "AGPL": "gnu affero general public license"}
_GNU_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2 1", "3"), "AGPL": ("3",)}
_COMMONS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
_COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
#: How sentences that name a licence begin; becomes "under ".
LEAD = (
    "^(?:this (?:work|file|program|software|project|document|text|library|code) is |it is )?"
    "(?:licensed|released|distributed|published|available|made available) under (?:the )?(?:terms of the )?|^spdx license identifier "
)
#: How they end where they point to the text.
TAIL = "(?: the license)?(?: see (?:the )?(?:accompanying )?(?:licen[sc]e|copying)(?: md| txt)?(?: file)?(?: for (?:more |the full )?(?:details|text|information))?)?$"

# Dates that stand behind the versions in titles.
_DATES = {"GPL-2": "june 1991", "GPL-3": "29 june 2007", "LGPL-2 1": "february 1999", "LGPL-3": "29 june 2007", "AGPL-3": "19 november 2007"}

# Sentences of licence texts with their identifiers.
_SENTENCES = {
    "all rights reserved": "AllRights",
    "this is free and unencumbered software released into the public domain": "Unencumbered",
    "this work is in the public domain": "PublicDomain",
    "released into the public domain": "PublicDomain",
    "this work is released into the public domain": "PublicDomain",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement": "MITAsIs",
    "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheCopy",
    "this source code form is subject to the terms of the mozilla public license, v 2.0": "MPLForm",
    "this program is free software": "GNUFree",
    "this library is free software": "GNUFree",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GNUNoWarranty",
}

# Ordered rules; longer ones are tried first.
_RULES = (
    (("MITGrant", "MITNotice", "MITAsIs"), "MIT"),
    (("MITGrant", "MITNotice"), "MIT"),
    (("MITGrant",), "MIT"),
    (("ISCGrant",), "ISC"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary"), "BSD-2-Clause"),
    (("Named:Apache-2.0", "ApacheComply", "ApacheCopy"), "Apache-2.0"),
    (("Named:Apache-2.0", "ApacheComply"), "Apache-2.0"),
    (("MPLForm",), "MPL-2.0"),
    (("Unencumbered",), "Unlicense"),
    (("PublicDomain",), "LicenseRef-public-domain"),
)
#: Full texts that a title can stand above.
_TITLED = {"MIT": "MITGrant", "ISC": "ISCGrant", "BSD-2-Clause": "BSDGrant", "BSD-3-Clause": "BSDGrant", "Unlicense": "Unencumbered"}

#: Every known sentence holds one of these words, so texts and sentences without them need no lookup.
CUES = ("licen", "released", "distributed", "published", "available", "rights", "domain", "permi", "warrant", "redistribut", "free software")

#: A line that goes on in the next one: no end of sentence before; behind it a small letter, a bracket, capitals or a
#: word that names of licences go on with, after the mark of a comment.
WRAPPED = (
    r"([^.!?:\s])[ \t]*\r?\n[ \t]*(?:(?:[*#;]+|//+|--)[ \t]*)?"
    r"([a-z(]|[A-Z][A-Z]|License|Licence|Foundation|General|Public|Software|Version [0-9])"
)
#: Points and colons that end no sentence.
INNER = r"([ (]v)\.[ ]*([0-9])|(license-identifier):()"
#: Ends of sentences.
BREAK = r"[.!?:;]*[ \t]*\r?\n|[.!?:;]+[ \t]"
_NOISE = "[^a-z0-9]+"
_MATCHED = r"\[([^\]]+)\]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _gnu() -> tuple[dict[str, str], list[tuple[tuple[str, ...], str]]]:
    """Sentences and rules of the GNU notices; a version stands in the sentence itself or in the one behind it."""
    known, found = {}, []
    start = "you can redistribute it and or modify it under the terms of the"
    foundation = "as published by the free software foundation"
    for lic, name in _GNU.items():
        known[f"see the {name} for more details"] = "GNUSee"
        known[f"{start} {name} {foundation}"] = f"GNUTerms:{lic}"
        for v in _GNU_VERSIONS[lic]:
            spdx = f"{lic}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            later, only = f"version {v} of the license or at your option any later version", f"version {v} of the license"
            known |= {f"either {later}": f"GNULater:{v}", later: f"GNULater:{v}", only: f"GNUOnly:{v}"}
            known |= {f"{start} {name} {foundation} either {later}": f"GNUTermsLater:{spdx}", f"{start} {name} {foundation} {only}": f"GNUTermsOnly:{spdx}",
                      f"{start} {name} version {v} {foundation}": f"GNUTermsOnly:{spdx}"}
            found += [((f"GNUTerms:{lic}", f"GNULater:{v}"), f"{spdx}-or-later"), ((f"GNUTerms:{lic}", f"GNUOnly:{v}"), f"{spdx}-only")]
            found += [((f"GNUTermsLater:{spdx}",), f"{spdx}-or-later"), ((f"GNUTermsOnly:{spdx}",), f"{spdx}-only")]
    return known, [(tuple(i.replace(" ", ".") for i in ids), lic) for ids, lic in found]


def _names() -> tuple[dict[str, str], dict[str, str]]:
    """Names of licences in a sentence, and as a title by itself, each as normalised text -> licence."""
    names = {form: lic for lic, forms in _NAMES.items() for form in forms}
    titles: dict[str, str] = {}
    for lic, name in _GNU.items():
        for v in _GNU_VERSIONS[lic]:
            spdx = f"{lic}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            for form in (f"{name} version {v}", f"{name} v {v}", f"{name} v{v}", f"{lic.lower()}v{v}", f"{lic.lower()} {v}", f"{lic.lower()} version {v}"):
                names |= {form: f"{spdx}-only", f"{form} or later": f"{spdx}-or-later"}
            titles[f"{name} version {v} {_DATES[f'{lic}-{v}']}"] = f"{spdx}-only"
            names |= {f"{spdx}-{kind}".lower().replace("-", " ").replace(".", " "): f"{spdx}-{kind}" for kind in ("only", "or-later")}
    for kind in _COMMONS:
        for v in _COMMONS_VERSIONS:
            lic = f"CC-{kind.upper().replace(' ', '-')}-{v.replace(' ', '.')}"
            names |= {f"cc {kind} {v}": lic, f"creative commons {kind} {v}": lic}
    titles |= {form: lic for form, lic in names.items() if "licen" in form}
    titles |= {f"the {form}": lic for form, lic in titles.items()} | {"the mit license mit": "MIT", "mit license mit": "MIT", "apache license version 2 0 january 2004": "Apache-2.0", "apache license version 2 0 january 2004 http www apache org licenses": "Apache-2.0"}
    # What SPDX calls them, too.
    names |= {re.sub("[^a-z0-9]+", " ", lic.lower()): lic for lic in _NAMES}
    return names, titles


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier: fixed ones, those of GNU notices, "under " with every name, and titles."""
    names, titles = _names()
    fixed = {re.sub("[^a-z0-9]+", " ", text).strip(): ident for text, ident in _SENTENCES.items()}
    gnu = {text: ident.replace(" ", ".") for text, ident in _gnu()[0].items()}
    return fixed | gnu | {f"under {form}": f"Named:{lic}" for form, lic in names.items()} | {form: f"Title:{lic}" for form, lic in titles.items()}


def rules() -> list[tuple[str, str]]:
    """``(identifier sequence, licence)``, longest first; a named licence and a title are rules by themselves."""
    alone = sorted({i for i in known_sentences().values() if i.startswith(("Named:", "Title:"))})
    ordered = [*_RULES, *_gnu()[1], *(((i,), i.split(":", 1)[1]) for i in alone)]
    # A title above its full text is one licence.
    ordered += [((f"Title:{lic}", *ids), lic) for ids, lic in _RULES if _TITLED.get(lic) == ids[0]]
    ordered.sort(key=lambda r: -len(r[0]))
    return [("".join(f"<{i}>" for i in seq), lic) for seq, lic in ordered]


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order, as ``<A><B>``."""
    known = known_sentences()
    table = F.map_from_arrays(F.array(*[F.lit(k) for k in known]), F.array(*[F.lit(v) for v in known.values()]))
    lower = F.regexp_replace(F.translate(F.regexp_replace(text, WRAPPED, "$1 $2"), _UPPER, _LOWER), INNER, "$1$3 $2$4")
    cut = F.split(lower, BREAK)
    normal = F.transform(F.filter(cut, has_cue), lambda s: F.regexp_replace(F.trim(F.regexp_replace(s, _NOISE, " ")), LEAD, "under "))
    normal = F.transform(normal, lambda s: F.when(s.startswith("under "), F.regexp_replace(s, TAIL, "")).otherwise(s))
    ids = F.filter(F.transform(normal, lambda s: F.try_element_at(table, s)), lambda i: i.isNotNull())
    return F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))))


def has_cue(text: Column) -> Column:
    found = F.lit(False)
    for cue in CUES:
        found = found | text.contains(cue)
    return found


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, sentence_ids, licenses, n_licenses)``, one row per row of ``docs``.

    ``licenses`` lists the licences of the text in the order of their
    sentences, repeats included, joined by ``,``.  ``docs`` needs ``doc_id``
    and ``text``; other columns are ignored.  Defined results: null, empty and
    licence-free texts give two empty strings and 0; repeated rows give
    repeated rows; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cued = has_cue(F.translate(text, _UPPER, _LOWER))
    rest = F.col("sentence_ids")
    for sequence, lic in rules():
        rest = F.replace(rest, F.lit(sequence), F.lit(f"[{lic}]"))
    return (
        docs.select("doc_id", F.when(cued, sentence_ids(text)).otherwise("").alias("sentence_ids"))
        .withColumn("_found", F.regexp_extract_all(rest, F.lit(_MATCHED), F.lit(1)))
        .select("doc_id", "sentence_ids", F.concat_ws(",", "_found").alias("licenses"), F.size("_found").alias("n_licenses"))
    )


def scan_sql(documents: str = "documents") -> str:
    """:func:`scan` for DuckDB."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in known_sentences().items())
    cued = " OR ".join(f"contains(s, {quoted(c)})" for c in CUES)
    rest = "sentence_ids"
    for sequence, lic in rules():
        rest = f"replace({rest}, {quoted(sequence)}, {quoted(f'[{lic}]')})"
    unwrapped = f"regexp_replace(coalesce(text, ''), {quoted(WRAPPED)}, '\\1 \\2', 'g')"
    lower = f"regexp_replace(translate({unwrapped}, '{_UPPER}', '{_LOWER}'), {quoted(INNER)}, '\\1\\3 \\2\\4', 'g')"
    cut = f"regexp_split_to_array({lower}, {quoted(BREAK)})"
    lead = f"regexp_replace(trim(regexp_replace(s, {quoted(_NOISE)}, ' ', 'g')), {quoted(LEAD)}, 'under ')"
    return f"""WITH known(sentence, ident) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {cut} AS cut FROM {documents}),
cuts AS (SELECT r, unnest(cut) AS s, generate_subscripts(cut, 1) AS n FROM docs),
found AS (SELECT r, string_agg('<' || ident || '>', '' ORDER BY n) AS ids
  FROM (SELECT r, n, CASE WHEN starts_with(t, 'under ') THEN regexp_replace(t, {quoted(TAIL)}, '') ELSE t END AS sentence FROM (SELECT r, n, {lead} AS t FROM cuts WHERE {cued})) JOIN known USING (sentence) GROUP BY r),
named AS (SELECT doc_id, coalesce(ids, '') AS sentence_ids FROM docs LEFT JOIN found USING (r)),
matched AS (SELECT *, regexp_extract_all({rest}, {quoted(_MATCHED)}, 1) AS l FROM named)
SELECT doc_id, sentence_ids, coalesce(array_to_string(l, ','), '') AS licenses, CAST(len(l) AS INTEGER) AS n_licenses FROM matched"""
