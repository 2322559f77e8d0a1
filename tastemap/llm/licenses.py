"""Licence scan by sentences and ordered rules.

A text is normalised (lower case, anything but letters and digits as one
space, so comment signs go too; sentence ends, empty lines and line breaks
stay as marks) and its known licence sentences become identifiers, in order.
Canonical sentences and references (``PHRASES``) count wherever they stand
within a sentence, also wrapped over lines; the shortened ``SENTENCES`` only
as a whole sentence or line, since other licences begin alike.  Of phrases
that begin at one word the longest counts.  The sequence of identifiers is
then matched against the rules in their order; what a rule has matched is
consumed, so a sentence that belongs to a whole notice isn't reported again
as a mere reference.

Every known sentence holds one of ``CUES`` or ``CC_BY``, so texts without any need no
normal form; that changes no result.  The scan is one projection: no exchange.

The SQL twin knows whole sentences on lines of their own alone (``SENTENCES``,
``RULES``), as the given tables hold them; it is no measure for full notices.

Edge cases: null and empty texts have no sentences and no licences; repeated
rows get equal results; a sentence may stand any number of times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers (fixed values).
SENTENCES = {
    "licensed under the apache license version 2 0": "APACHE2.REF",
    "you may not use this file except in compliance with the license": "APACHE2.COMPLY",
    "you may obtain a copy of the license at": "APACHE2.COPY",
    "released under the mit license": "MIT.REF",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "MIT.GRANT",
    "the above copyright notice and this permission notice shall be included in all copies": "MIT.NOTICE",
    "the software is provided as is without warranty of any kind": "MIT.ASIS",
    "this work is licensed under the gnu general public license version 3": "GPL3.REF",
    "this program is free software you can redistribute it under the terms of the gnu general public license": "GPL.FREE",
    "this program is distributed without any warranty": "GPL.NOWARRANTY",
    "redistributions of source code must retain the above copyright notice": "BSD.SOURCE",
    "redistributions in binary form must reproduce the above copyright notice": "BSD.BINARY",
    "licensed under cc by nc 4 0": "CCBYNC4.REF",
    "licensed under cc by 4 0": "CCBY4.REF",
    "all rights reserved under copyright": "RESERVED",
}
# Licence and the sequence of identifiers that shows it, most telling first.
RULES = (
    ("MIT", ("MIT.GRANT", "MIT.NOTICE", "MIT.ASIS")),
    ("Apache-2.0", ("APACHE2.REF", "APACHE2.COMPLY", "APACHE2.COPY")),
    ("GPL-3.0", ("GPL.FREE", "GPL.NOWARRANTY")),
    ("BSD-2-Clause", ("BSD.SOURCE", "BSD.BINARY")),
    ("Apache-2.0", ("APACHE2.REF",)),
    ("MIT", ("MIT.REF",)),
    ("GPL-3.0", ("GPL3.REF",)),
    ("CC-BY-NC-4.0", ("CCBYNC4.REF",)),
    ("CC-BY-4.0", ("CCBY4.REF",)),
    ("proprietary", ("RESERVED",)),
)
CUES = ("licen", "permission", "copyright", "warranty", "gnu", "redistribut", "software", "creative", "spdx", "mozilla", "mpl", "cc0",
        "domain", "zlib", "gpl", "apache")
CC_BY = r"cc[^a-z0-9]+by"           # a cue as well, whatever stands between the words
SPLIT = r"[.!?]+[\x20\x09-\x0D]+|[\x0A\x0D]+"
OTHER = r"[^a-z0-9]+"

_GRANT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
          "documentation files the software to deal in the software without restriction including without limitation "
          "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
          "permit persons to whom the software is furnished to do so subject to the following conditions")
_ASIS = ("the software is provided as is without warranty of any kind express or implied including but not limited to "
         "the warranties of merchantability fitness for a particular purpose and ")
_KEPT = "included in all copies or substantial portions of the software"
_FREE = "is free software you can redistribute it and or modify it under the terms of "
_BY = " as published by the free software foundation "
_UNDER = [f"{verb} under {terms}" for verb in ("licensed", "released", "distributed", "available", "published", "provided")
          for terms in ("", "the terms of ")]
_LICENCE = ("license", "licence")


def _gpl(n: int) -> list[str]:
    """What the header of the GNU GPL of version ``n`` says of the terms."""
    gnu = "the gnu general public license"
    version = [f"version {n} of the license", f"version {n}"]
    return ([f"{_FREE}{gnu}{_BY}{either}{v}" for either in ("", "either ") for v in version]
            + [f"{_FREE}{gnu} version {n}{_BY}".rstrip(), f"{_FREE}version {n} of {gnu}{_BY}".rstrip()])


def _gpl_references(n: int) -> list[str]:
    versions = [f"{v}{n}{zero}" for v in ("version ", "v") for zero in ("", " 0")]
    return [f"{u}{the}gnu general public {word} {v}" for u in _UNDER for the in ("", "the ") for word in _LICENCE for v in versions]


def _references(*names: str) -> list[str]:
    return [f"{u}{the}{name}" for u in _UNDER for the in ("", "the ") for name in names]


def _lesser(name: str, n: str) -> list[str]:
    """What the header of the GNU LGPL or AGPL of version ``n`` says of the terms."""
    gnu = f"the gnu {name} general public license"
    return [f"{_FREE}{gnu}{_BY}{either}version {n}{of}" for either in ("", "either ") for of in ("", " of the license")]


# SPDX short identifiers and the licence each stands for (fixed values).
SPDX = ("MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
        "AGPL-3.0", "MPL-2.0", "ISC", "Zlib", "Unlicense", "BSL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
        "0BSD", "PostgreSQL", "WTFPL")
_GNU = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")


def _plain(text: str) -> str:
    return "".join(c if c.isalnum() else " " for c in text.lower())


def _spdx() -> dict[str, list[str]]:
    """Identifier lines: one licence, GNU ones also with -only, -or-later or +;
    or a choice of two."""
    lead, out = "spdx license identifier ", {}
    for name in SPDX:
        ends = ("", " only", " or later") if name in _GNU else ("",)
        out[f"SPDX.{name}"] = [lead + _plain(name) + end for end in ends]
    for a in SPDX:
        for b in SPDX:
            if a != b and {a, b} & {"MIT", "Apache-2.0"}:
                out[f"SPDX.{a} OR {b}"] = [f"{lead}{_plain(a)} or {_plain(b)}"]
    return out


_DUAL = [f"{u}{the}{a}{w1} or {t2}{b}" for u in [*_UNDER, "dual licensed under "] for the in ("", "the ", "either the ", "either ")
         for a, b in (("mit", "apache 2 0"),) for w1 in ("", " license") for t2 in ("", "the ")]
_DUAL += [d.replace("apache 2 0", "apache license version 2 0") for d in _DUAL]
_DUAL += [f"{u}{the}apache {v} or {t2}mit" for u in [*_UNDER, "dual licensed under "] for the in ("", "the ", "either the ", "either ")
          for v in ("2 0", "license 2 0", "license version 2 0") for t2 in ("", "the ")]

# Canonical sentences and references, with variants, by identifier.
PHRASES = {
    "MIT.GRANT": [_GRANT, _GRANT.replace("documentation files the software", "documentation the software")],
    "MIT.NOTICE": [f"the above copyright notice and this permission notice {next_one}shall be {_KEPT}"
                   for next_one in ("", "including the next paragraph ")],
    "MIT.ASIS": [_ASIS + word for word in ("noninfringement", "non infringement")],
    "APACHE2.REF": [f"{u}{the}apache license {v}" for u in [*_UNDER, "licenses this file to you under "]
                    for the in ("", "the ") for v in ("version 2 0", "v2 0", "2 0")] + ["apache license version 2 0 january 2004"],
    "APACHE2.COMPLY": ["you may not use this file except in compliance with the license"],
    "APACHE2.COPY": ["you may obtain a copy of the license at"],
    "MIT.REF": [f"{u}{the}mit {word}" for u in _UNDER for the in ("", "the ") for word in _LICENCE],
    "GPL3.FREE": _gpl(3),
    "GPL2.FREE": _gpl(2),
    "GPL.NOWARRANTY": ["is distributed in the hope that it will be useful but without any warranty without even the implied "
                       f"warranty of merchantability {j} fitness for a particular purpose" for j in ("or", "and")],
    "GPL3.REF": ["this work is licensed under the gnu general public license version 3",
                 "gnu general public license version 3 29 june 2007", *_gpl_references(3)],
    "GPL2.REF": ["gnu general public license version 2 june 1991", *_gpl_references(2)],
    "BSD.SOURCE": [f"redistributions of source code must retain the {above}copyright notice this list of conditions and the "
                   "following disclaimer" for above in ("", "above ")],
    "BSD.BINARY": [f"redistributions in binary form must reproduce the {above}copyright notice this list of conditions and the "
                   "following disclaimer in the documentation and or other materials provided with the distribution"
                   for above in ("", "above ")],
    "BSD.ADVERT": ["all advertising materials mentioning features or use of this software must display the following "
                   f"acknowledg{e}ment" for e in ("", "e")],
    "BSD.NAME": [f"{names} may be used to endorse or promote products derived from this software without specific prior "
                 "written permission" for names in ("nor the names of its contributors", "nor the names of any contributors",
                                                    "nor the names of other contributors", "nor the names of the contributors")],
    "CCBYNC4.REF": [f"{u}{c}" for u in _UNDER for c in (
        "cc by nc 4 0", "the cc by nc 4 0", "a creative commons attribution noncommercial 4 0",
        "the creative commons attribution noncommercial 4 0", "a creative commons attribution non commercial 4 0",
        "the creative commons attribution non commercial 4 0")],
    "CCBY4.REF": [f"{u}{c}" for u in _UNDER for c in (
        "cc by 4 0", "the cc by 4 0", "a creative commons attribution 4 0", "the creative commons attribution 4 0")],
    "RESERVED": ["all rights reserved under copyright"],
    "DUAL.MIT-APACHE2": _DUAL,
    "LGPL3.FREE": _lesser("lesser", "3"),
    "LGPL21.FREE": _lesser("lesser", "2 1"),
    "AGPL3.FREE": _lesser("affero", "3"),
    "LGPL3.REF": _references("gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl 3 0", "lgpl v3")
    + ["gnu lesser general public license version 3 29 june 2007"],
    "LGPL21.REF": _references("gnu lesser general public license version 2 1", "lgpl 2 1", "lgpl v2 1")
    + ["gnu lesser general public license version 2 1 february 1999"],
    "AGPL3.REF": _references("gnu affero general public license version 3", "gnu affero general public license v3", "agpl 3 0", "agpl v3")
    + ["gnu affero general public license version 3 19 november 2007"],
    # "v. 2.0" ends a sentence after the v, for the scan.
    "MPL2.FORM": ["this source code form is subject to the terms of the mozilla public license " + v for v in ("v", "version 2 0", "2 0")],
    "MPL2.COPY": ["if a copy of the mpl was not distributed with this file you can obtain one at"],
    "MPL2.REF": _references("mozilla public license 2 0", "mozilla public license version 2 0", "mpl 2 0")
    + ["mozilla public license version 2 0"],
    "ISC.GRANT": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies",
                  "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
                  "provided that the above copyright notice and this permission notice appear in all copies"],
    "ISC.ASIS": ["the software is provided as is and the author disclaims all warranties with regard to this software including all "
                 "implied warranties of merchantability and fitness",
                 "the software is provided as is and isc disclaims all warranties with regard to this software including all "
                 "implied warranties of merchantability and fitness"],
    "ISC.REF": _references("isc license", "isc licence"),
    "0BSD.GRANT": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "UNLICENSE.FREE": ["this is free and unencumbered software released into the public domain"],
    "UNLICENSE.ANYONE": ["anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
                         "as a compiled binary for any purpose commercial or non commercial and by any means"],
    "UNLICENSE.REF": _references("unlicense"),
    "BSL1.GRANT": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
                   "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
                   "transmit the software"],
    "BSL1.REF": _references("boost software license version 1 0", "boost software license 1 0")
    + ["boost software license version 1 0 august 17th 2003"],
    "ZLIB.ASIS": ["this software is provided as is without any express or implied warranty"],
    "ZLIB.GRANT": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
                   "it and redistribute it freely subject to the following restrictions"],
    "ZLIB.REF": _references("zlib license"),
    "EPL2.REF": [f"{made} available under the terms of the eclipse public license {v}" for made in ("made", "are made", "is made")
                 for v in ("2 0", "v2 0", "version 2 0")] + _references("eclipse public license 2 0", "eclipse public license version 2 0"),
    "CC0.REF": _references("cc0 1 0", "cc0", "cc0 1 0 universal", "creative commons zero v1 0 universal") + [
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        "cc0 1 0 universal cc0 1 0 public domain dedication"],
    "CCBYSA4.REF": [f"{u}{c}" for u in _UNDER for c in (
        "cc by sa 4 0", "the cc by sa 4 0", "a creative commons attribution sharealike 4 0", "the creative commons attribution sharealike 4 0",
        "a creative commons attribution share alike 4 0", "the creative commons attribution share alike 4 0")],
    **_spdx(),
}
# Rules of canonical sentences, before those of ``RULES``.
NOTICES = (
    ("ISC", ("ISC.GRANT", "ISC.ASIS")),
    ("MPL-2.0", ("MPL2.FORM", "MPL2.COPY")),
    ("Unlicense", ("UNLICENSE.FREE", "UNLICENSE.ANYONE")),
    ("Zlib", ("ZLIB.ASIS", "ZLIB.GRANT")),
    ("LGPL-3.0", ("LGPL3.FREE", "GPL.NOWARRANTY")),
    ("LGPL-2.1", ("LGPL21.FREE", "GPL.NOWARRANTY")),
    ("AGPL-3.0", ("AGPL3.FREE", "GPL.NOWARRANTY")),
    ("GPL-3.0", ("GPL3.FREE", "GPL.NOWARRANTY")),
    ("GPL-2.0", ("GPL2.FREE", "GPL.NOWARRANTY")),
    ("BSD-4-Clause", ("BSD.SOURCE", "BSD.BINARY", "BSD.ADVERT", "BSD.NAME")),
    ("BSD-3-Clause", ("BSD.SOURCE", "BSD.BINARY", "BSD.NAME")),
)
MORE = (
    ("GPL-3.0", ("GPL3.FREE",)),
    ("GPL-2.0", ("GPL2.FREE",)),
    ("GPL-2.0", ("GPL2.REF",)),
    ("MIT OR Apache-2.0", ("DUAL.MIT-APACHE2",)),
    ("LGPL-3.0", ("LGPL3.FREE",)),
    ("LGPL-2.1", ("LGPL21.FREE",)),
    ("AGPL-3.0", ("AGPL3.FREE",)),
    ("LGPL-3.0", ("LGPL3.REF",)),
    ("LGPL-2.1", ("LGPL21.REF",)),
    ("AGPL-3.0", ("AGPL3.REF",)),
    ("MPL-2.0", ("MPL2.FORM",)),
    ("MPL-2.0", ("MPL2.REF",)),
    ("ISC", ("ISC.GRANT",)),
    ("ISC", ("ISC.REF",)),
    ("0BSD", ("0BSD.GRANT",)),
    ("Unlicense", ("UNLICENSE.FREE",)),
    ("Unlicense", ("UNLICENSE.REF",)),
    ("BSL-1.0", ("BSL1.GRANT",)),
    ("BSL-1.0", ("BSL1.REF",)),
    ("Zlib", ("ZLIB.GRANT",)),
    ("Zlib", ("ZLIB.REF",)),
    ("EPL-2.0", ("EPL2.REF",)),
    ("CC0-1.0", ("CC0.REF",)),
    ("CC-BY-SA-4.0", ("CCBYSA4.REF",)),
    *((i.removeprefix("SPDX."), (i,)) for i in _spdx()),
)
KNOWN = {**SENTENCES, **{phrase: i for i, phrases in PHRASES.items() for phrase in phrases}}


def _pattern() -> str:
    """A known sentence in the normal form: words parted by a space or a line
    break, whole words, the longest of those that begin alike."""
    tree: dict = {}
    inside = {phrase for phrases in PHRASES.values() for phrase in phrases}
    for phrase in KNOWN:
        at = tree
        for word in phrase.split():
            at = at.setdefault(word, {})
        at[""] = r"(?=[ \n|])" if phrase in inside else r"(?<=[\n|]" + phrase.replace(" ", r"[ \n]") + r")(?=[\n|])"

    def told(at: dict) -> str:
        more = [word + told(rest) for word, rest in at.items() if word]
        ways = [r"[ \n](?:" + "|".join(more) + ")"] if more else []
        ways += [at[""]] if "" in at else []
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return r"(?<=[ \n|])(?:" + "|".join(word + told(rest) for word, rest in tree.items()) + ")"


def normal(text: Column) -> Column:
    """Words parted by a space, by a line break within a sentence, or by ``|``
    where a sentence or a paragraph ends."""
    low = F.translate(F.replace(F.lower(text), F.lit("\r\n"), F.lit("\n")), "\r|", "\n ")
    low = F.regexp_replace(low, r"\n[ \t]*(?:rem|dnl)(?=[ \t\n])", "\n")         # comment signs of letters
    ends = F.regexp_replace(low, r"[.!?]++(?=[\x20\x09-\x0D]|\z)|\n[^a-z0-9\n]*+(?=\n)", "|")
    words = F.regexp_replace(ends, r"[^a-z0-9|\n]++", " ")
    words = F.regexp_replace(F.concat(F.lit("|"), words, F.lit("|")), r"[ \n]*\|[ \n|]*+", "|")
    return F.regexp_replace(words, r" ?\n ?", "\n")


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's known sentences, in order."""
    known = F.create_map(*[F.lit(v) for pair in KNOWN.items() for v in pair])
    found = F.regexp_extract_all(normal(text), F.lit(_pattern()), F.lit(0))
    ids = F.transform(found, lambda s: F.try_element_at(known, F.translate(s, "\n", " ")))
    low = F.lower(text)
    cue = low.rlike(CC_BY)
    for c in CUES:
        cue = cue | low.contains(c)
    none = F.array().cast("array<string>")
    return F.when(cue, ids).otherwise(none)


def marked(ids) -> str:
    return "".join(f"<{i}>" for i in ids)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids, licenses (comma-joined,
    in the order of the rules), for every row of doc_id, text."""
    rows = docs.select("doc_id", F.coalesce(sentence_ids(F.col("text")), F.array().cast("array<string>")).alias("ids"))
    left = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    rows = rows.withColumn("left", left).withColumn("found", F.array().cast("array<string>"))
    single = [(name, sequence) for name, sequence in (*RULES, *MORE) if len(sequence) == 1]
    for name, sequence in (*NOTICES, *(r for r in (*RULES, *MORE) if len(r[1]) > 1)):
        here = F.col("left").contains(marked(sequence))
        rows = rows.select("doc_id", "ids", F.replace("left", F.lit(marked(sequence)), F.lit("<>")).alias("left"),
                           F.when(here, F.array_append("found", F.lit(name))).otherwise(F.col("found")).alias("found"))
    # Rules of one identifier consume nothing that another rule needs: one look for all, in their order.
    rest = F.split("left", "[<>]+")
    named = [F.when(F.array_contains(rest, sequence[0]), F.lit(name)) for name, sequence in single]
    rows = rows.select("doc_id", "ids", F.concat("found", F.filter(F.array(*named), lambda x: x.isNotNull())).alias("found"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"),
                       F.array_join(F.array_distinct("found"), ",").alias("licenses"))


def sql() -> str:
    """The scan in DuckDB's SQL, from the same tables of sentences and rules."""
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    step = "(SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS rest, []::VARCHAR[] AS found FROM g)"
    for name, sequence in RULES:
        m = marked(sequence)
        step = (f"(SELECT doc_id, ids, replace(rest, '{m}', '<>') AS rest, "
                f"CASE WHEN contains(rest, '{m}') AND NOT list_contains(found, '{name}') "
                f"THEN list_append(found, '{name}') ELSE found END AS found FROM {step})")
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
s AS (
  SELECT row, doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k
  FROM (SELECT row_number() OVER () AS row, doc_id,
               string_split_regex(coalesce(text, ''), '{SPLIT}') AS parts FROM documents)),
m AS (
  SELECT row, k, id FROM s JOIN known ON sentence = trim(regexp_replace(lower(part), '{OTHER}', ' ', 'g'))),
d AS (SELECT row_number() OVER () AS row, doc_id FROM documents),
g AS (
  SELECT any_value(d.doc_id) AS doc_id, coalesce(list(id ORDER BY k) FILTER (WHERE id IS NOT NULL), []) AS ids
  FROM d LEFT JOIN m USING (row) GROUP BY d.row)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(found, ',') AS licenses
FROM {step}"""
