"""Licences in texts by sentence rules, with column expressions only.

A text is split into sentences, whose lines are joined, each normalised (lower case, words
and version numbers joined by single blanks). Known licence sentences, given as patterns of a normalised
sentence, map to identifiers; a text becomes the sequence of its identifiers. Ordered
rules are patterns over that sequence: the first ones name licences by their whole
wording, later ones by parts or by a reference, and what a rule has read is closed to
the rules after it. Identifiers that no rule reads make the text ``UNKNOWN``. An SPDX tag
names its licences itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers and patterns of normalised licence sentences. A pattern is
# to match the whole sentence; the first that does gives the identifier.
SENTENCES = (
    ("MitGrant", r"permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    ("MitNotice", r"the above copyright notice and this permission notice (shall|must) be included in all copies or substantial portions of the software"),
    ("MitRef", r"(.* )?(licensed|released|distributed|available|published) under (the )?(terms of )?(the )?(mit|expat) license( .*)?"),
    ("MitName", r"(the )?mit license( mit)?"),
    ("SoftAsIs", r"the software is provided as is without warranty of any kind .*"),
    ("SoftNoLiability", r"in no event shall the authors or copyright holders be liable .*"),
    ("BsdGrant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BsdSource", r"(\d )?redistributions of source code must retain the above copyright notice .*"),
    ("BsdBinary", r"(\d )?redistributions in binary form must reproduce the above copyright notice .*"),
    ("BsdEndorse", r"(\d )?neither the name of .* (endorse|may be used to endorse) .*"),
    ("BsdAdvert", r"(\d )?all advertising materials mentioning features or use of this software must display .*"),
    ("BsdAsIs", r"this software is provided by .* as is and any express or implied warranties .*"),
    ("BsdNoLiability", r"in no event shall .* be liable for any direct indirect incidental .*"),
    ("BsdRef", r"(.* )?(licensed|released|distributed|available|governed|use of this source code is governed) (under|by) (a|the) (new |modified |simplified |\d clause )?bsd(style| style)?( \d clause)? license( .*)?"),
    ("Apache2Grant", r"(.* )?licensed under the apache license version 2(\.0)?( .*)?"),
    ("Apache2Comply", r"you may not use this (file|work|software) except in compliance with the license"),
    ("Apache2Copy", r"you may obtain a copy of the license at( .*)?"),
    ("Apache2AsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("Apache2Limits", r"see the license for the specific language governing permissions and limitations under the license"),
    ("AgplGrant", r".*(gnu )?affero general public license( .*)? version 3( .*)?"),
    ("LgplGrant", r".*(gnu )?(lesser|library) general public license( .*)?"),
    ("Gpl2Later", r".*gnu general public license .*either version 2( .*)?any later version.*"),
    ("Gpl3Later", r".*gnu general public license .*either version 3( .*)?any later version.*"),
    ("Gpl2Only", r".*gnu general public license,? version 2( .*)?"),
    ("Gpl3Only", r".*gnu general public license,? version 3( .*)?"),
    ("GplCopy", r"you should have received a copy of the gnu general public license( .*)?"),
    ("GplDetails", r"see the gnu general public license for more details"),
    ("GplAny", r".*gnu general public license.*"),
    ("GnuNoWarranty", r"(this|.* ) ?program is distributed in the hope that it will be useful .*"),
    ("MplGrant", r"(.* )?subject to the terms of the mozilla public license (v|version) ?2 ?\.0( .*)?"),
    ("MplRef", r".*mozilla public license( .*)?"),
    ("IscGrant", r"permission to use copy modify and ?or distribute this software for any purpose with or without fee is hereby granted .*"),
    ("IscRef", r"(.* )?under (the )?(terms of )?(the )?isc license( .*)?"),
    ("UnlicenseGrant", r"this is free and unencumbered software released into the public domain"),
    ("PublicDomain", r".*(released|placed|dedicated) (in|into|to) the public domain( .*)?"),
    ("BoostGrant", r".*boost software license( .*)?"),
    ("ZlibGrant", r"permission is granted to anyone to use this software for any purpose including commercial applications .*"),
    ("EplGrant", r".*eclipse public license( .*)?"),
    ("CcZero", r".*(cc0|creative commons zero)( .*)?"),
    ("CcByNcNd", r".*(cc by nc nd|attribution noncommercial noderivatives|attribution non commercial no derivatives)( .*)?"),
    ("CcByNcSa", r".*(cc by nc sa|attribution noncommercial sharealike|attribution non commercial share alike)( .*)?"),
    ("CcByNc", r".*(cc by nc|creative commons attribution non ?commercial)( .*)?"),
    ("CcByNd", r".*(cc by nd|creative commons attribution no ?derivatives)( .*)?"),
    ("CcBySa", r".*(cc by sa|creative commons attribution share ?alike)( .*)?"),
    ("CcBy", r".*(cc by|creative commons attribution)( .*)?"),
    ("AllRights", r"(.* )?all rights reserved"),
    ("Copyright", r"copyright (c )?.*"),
    ("SpdxTag", r"spdx license identifier .*"),
    ("LicenseWord", r"(.* )?licen[sc]ed? under (.* )?(license|licence|terms)( .*)?"),
)

# Licences and patterns over the sequence of identifiers (each followed by
# a comma), in the order they are tried.
RULES = (
    ("MIT", r"MitGrant,MitNotice,(SoftAsIs,)?(SoftNoLiability,)?"),
    ("BSD-4-Clause", r"BsdGrant,BsdSource,BsdBinary,BsdAdvert,(BsdEndorse,)?(BsdAsIs,)?(BsdNoLiability,)?"),
    ("BSD-3-Clause", r"BsdGrant,BsdSource,BsdBinary,BsdEndorse,(BsdAsIs,)?(BsdNoLiability,)?"),
    ("BSD-2-Clause", r"BsdGrant,BsdSource,BsdBinary,(BsdAsIs,)?(BsdNoLiability,)?"),
    ("Apache-2.0", r"Apache2Grant,(Apache2Comply,)?(Apache2Copy,)?(Apache2AsIs,)?(Apache2Limits,)?"),
    ("AGPL-3.0", r"AgplGrant,(GnuNoWarranty,)?"),
    ("LGPL", r"(LgplGrant,)+(GnuNoWarranty,)?(LgplGrant,)*"),
    ("GPL-2.0-or-later", r"Gpl2Later,(GnuNoWarranty,)?(GplDetails,)?(GplCopy,)?"),
    ("GPL-3.0-or-later", r"Gpl3Later,(GnuNoWarranty,)?(GplDetails,)?(GplCopy,)?"),
    ("GPL-2.0-only", r"Gpl2Only,(GnuNoWarranty,)?(GplDetails,)?(GplCopy,)?"),
    ("GPL-3.0-only", r"Gpl3Only,(GnuNoWarranty,)?(GplDetails,)?(GplCopy,)?"),
    ("MPL-2.0", r"MplGrant,(MplRef,)*"),
    ("ISC", r"IscGrant,(SoftAsIs,)?"),
    ("Unlicense", r"UnlicenseGrant,"),
    ("Zlib", r"ZlibGrant,"),
    ("MIT", r"MitRef,|MitName,|MitGrant,"),
    ("BSD", r"BsdRef,|BsdGrant,"),
    ("MPL", r"MplRef,"),
    ("ISC", r"IscRef,"),
    ("BSL-1.0", r"BoostGrant,"),
    ("EPL", r"EplGrant,"),
    ("CC0-1.0", r"CcZero,"),
    ("CC-BY-NC-ND", r"CcByNcNd,"),
    ("CC-BY-NC-SA", r"CcByNcSa,"),
    ("CC-BY-NC", r"CcByNc,"),
    ("CC-BY-ND", r"CcByNd,"),
    ("CC-BY-SA", r"CcBySa,"),
    ("CC-BY", r"CcBy,"),
    ("GPL", r"GplAny,|GplCopy,|GplDetails,"),
    ("public-domain", r"PublicDomain,"),
)

#: Identifiers that alone do not make a licence, and need no rule.
NEUTRAL = ("Copyright", "AllRights", "SoftAsIs", "SoftNoLiability", "GnuNoWarranty")

#: Forms of patterns that have two places to search for: where the first place found is not enough, no
#: later one is, so each sentence is read once (as in SENTENCES, a test compares them; the time there
#: grows with the square of a sentence's length and more).
LINEAR = {
    "AgplGrant": r"(?>.*?affero general public license(?= )).*? version 3( .*)?",
    "Gpl2Later": r"(?>.*?gnu general public license )(?>.*?either version 2(?= |any later version)).*any later version.*",
    "Gpl3Later": r"(?>.*?gnu general public license )(?>.*?either version 3(?= |any later version)).*any later version.*",
    "LicenseWord": r"(?>(?:|.*? )licen[sc]ed? under )(.* )?(license|licence|terms)( .*)?",
}

#: A sentence without any of these cannot be a known one (a test holds them against SENTENCES).
HINTS = ("licen", "software", "tribution", "endorse", "liable", "hope", "domain", "copyright", "reserved", "commons", "cc")


def keys(pattern: str) -> list[str]:
    """Texts of which every match of one of SENTENCES holds one."""

    def longest(part: str) -> str:
        return max(re.split(r"\.\*|\\d|\([^()]*\)\??|\[[^\]]*\]|.\?", part.replace(r"\.", "\0")), key=len).replace("\0", ".")

    if whole := longest(pattern):
        return [whole]
    return [longest(x) for x in re.findall(r"\(([^()]*)\)(?!\?)", pattern)[0].split("|")]


#: An SPDX tag; what follows on its line is an expression of names.
_TAG = r"spdx-license-identifier[ \t]*:"
#: One name of an expression, after its start or an operator.
_NAME = r"(?>[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?)"
_NAMES = rf"(?i)(?:^[\s(]*|\G(?:[\s)]+(?:and|or)[\s(]+|/))({_NAME}(?:\s+with\s+{_NAME})?)(?![a-z0-9.+-]*:)"
#: Names in their own spelling (SPDX names are the same in any case); other names stay as written.
SPDX = (
    "MIT", "MIT-0", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "Apache-1.1", "Apache-2.0", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "MPL-1.1", "MPL-2.0", "ISC", "Unlicense", "Zlib", "BSL-1.0", "EPL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-ND-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "Artistic-2.0", "WTFPL", "Python-2.0", "PSF-2.0", "OFL-1.1",
)
_GNU = [f"{x}-{v}" for x, versions in (("AGPL", ("3.0",)), ("LGPL", ("2.0", "2.1", "3.0")), ("GPL", ("1.0", "2.0", "3.0"))) for v in versions]
_SPELLING = {x.lower(): x for x in SPDX} | {f"{x.lower()}{e}": x + y for x in _GNU for e, y in (("", "-only"), ("+", "-or-later"))}
#: Identifiers of names begin so; the licence is the rest.
SPDX_PREFIX = "Spdx:"

#: Line starts (after the comment leader) at which a new sentence begins without a sentence end before it.
_STARTS = (
    r"permission (?:is hereby granted|to use|is granted)|the above copyright notice and|the software is provided|in no event shall"
    r"|redistributions? (?:and use|of source|in binary)|neither the name|all advertising materials|all rights reserved"
    r"|this software is provided|unless required by applicable|you may (?:obtain a copy|not use this)|see the (?:gnu|license)"
    r"|you should have received|this program is|this is free and unencumbered|licen[sc]ed under|(?:the )?mit license"
)
#: A line of its own with a year or sign; other lines that begin so are parts of sentences.
_COPYRIGHT = r"copyright(?=[^\n]*(?:\(c\)|\u00a9|\b(?:19|20)\d\d))"
_LEADER = r"(?imd)^[^a-z0-9\n]*+(?:(?:dnl|rem)(?:[ \t]+|$))?"


def _paragraphs(text: Column) -> Column:
    """The text without comment leaders; lines without letters and digits are empty."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), _LEADER, "")
    plain = F.regexp_replace(plain, rf"(?imd)^({_COPYRIGHT}[^\n]*)$", "\n$1\n")
    return F.regexp_replace(plain, rf"(?i)({_TAG}[^\n]*)", "\n\n$1\n\n")


def _sentences(text: Column) -> Column:
    """Sentences with their line ends: cut at empty lines, after . ! ? : before a blank, and
    before lines that begin a sentence."""
    tag, end = r"spdx-license-identifier[ \t]{0,9}", "[.!?:]"
    # a run of marks is read once, from its first one, or from the second if the first belongs to a tag
    begins = rf"{end}(?:(?<!{end}.)(?<!{tag}.)|(?<={tag}{end}.))"
    return F.split(_paragraphs(text), rf"(?i)\n{{2,}}|{begins}{end}*+(?=\s|$)|\n(?=(?:{_STARTS})\b)", -1)


def normalised(s: Column) -> Column:
    """Runs of letters, digits and inner dots, in lower case, joined by single blanks."""
    words = F.regexp_replace(F.lower(s), r"[^a-z0-9.]+|(?<![0-9])\.|\.(?![0-9])", " ")
    return F.trim(F.regexp_replace(words, " +", " "))


def _holds(s: Column, texts: Iterable[str]) -> Column:
    return reduce(or_, (F.contains(s, F.lit(x)) for x in texts))


def _identifier(sentence: Column) -> Column:
    """Number of the first of SENTENCES that matches, or null."""
    found = F.lit(None).cast("int")
    for k, (name, pattern) in reversed(list(enumerate(SENTENCES))):
        found = F.when(_holds(sentence, keys(pattern)) & sentence.rlike(f"^(?:{LINEAR.get(name, pattern)})$"), k).otherwise(found)
    return F.when(_holds(sentence, HINTS), found)


def _known(s: Column) -> Column:
    # by way of an array, so that the sentence is normalised once and not for every pattern
    return F.array_compact(F.transform(F.array(normalised(s)), _identifier))


def _spdx(s: Column) -> Column:
    """Identifiers of the names of an SPDX tag; one of no public name is ``SpdxTag``."""
    spelling = F.create_map(*(F.lit(x) for pair in _SPELLING.items() for x in pair))

    def name(written: Column) -> Column:
        return F.array_join(F.transform(F.split(written, r"(?i)\s+with\s+"), lambda x: F.coalesce(spelling[F.lower(x)], x)), " WITH ")

    written = F.regexp_extract_all(F.regexp_replace(s, rf"(?i)^{_TAG}", ""), F.lit(_NAMES), 1)
    named = F.transform(written, lambda x: F.when(x.rlike("(?i)^(?:licenseref-.*|none|noassertion)$"), "SpdxTag").otherwise(F.concat(F.lit(SPDX_PREFIX), name(x))))
    return F.when(F.size(written) > 0, named).otherwise(F.array(F.lit("SpdxTag")))


def _whole_or(whole: Column, parts: Column) -> Column:
    """What a sentence says as a whole, where that is more than any of its parts says."""
    return F.when((F.size(whole) > 0) & ((F.size(parts) == 0) | (F.element_at(whole, 1) < F.array_min(parts))), whole).otherwise(parts)


def _either(s: Column, cut: str, known) -> Column:
    """Numbers of a sentence read as a whole and, where it has several parts, by parts."""
    pair = F.array(F.struct(_known(s).alias("whole"), F.flatten(F.transform(F.split(s, cut, -1), known)).alias("parts")))
    both = F.element_at(F.transform(pair, lambda x: _whole_or(x["whole"], x["parts"])), 1)
    return F.when(s.rlike(cut), both).otherwise(known(s))


def identifiers(text: Column) -> Column:
    """The known licence sentences of a text, in order.

    A sentence is read with its lines joined, so wrapped texts are known. Its clauses
    (between semicolons) and lines are read too; they count unless what they are part of
    is a sentence that comes before theirs in SENTENCES. An SPDX tag is a sentence with an
    identifier for each name of its expression."""
    likely = F.filter(_sentences(text), lambda s: F.exists(F.array(F.lower(s)), lambda x: _holds(x, HINTS)))
    names = F.array(*(F.lit(n) for n, _ in SENTENCES))

    def of(s: Column) -> Column:
        numbers = _either(s, r"(?<!;);++(?=\s|$)", lambda c: _either(c, r"\n", _known))
        return F.when(s.rlike(f"(?i)^{_TAG}"), _spdx(s)).otherwise(F.transform(numbers, lambda k: F.get(names, k)))

    return F.flatten(F.transform(likely, of))


def licenses(docs: DataFrame) -> DataFrame:
    """Licences of each text.

    ``docs`` needs ``doc_id`` and ``text``. Returns one row per input row: ``doc_id``,
    ``n_sentences`` (known sentences; an SPDX tag counts once for each of its names),
    ``sentence_ids`` (their identifiers in order, joined by commas), ``licenses``
    (distinct names in the order of the rules, then those of SPDX tags as they come,
    joined by commas) and ``unknown`` (whether an identifier that names a licence was
    read by no rule; also an SPDX tag without a public name). A null text counts as empty: 0, '', '' and false. Repeated rows each get a
    row; an empty table gives none. No shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a text without a hint has no known sentence; most texts end here
    ids = F.when(_holds(F.col("low"), HINTS), identifiers(F.col("text"))).otherwise(F.expr("cast(array() as array<string>)"))
    rows = docs.select("doc_id", text.alias("text"), F.lower(text).alias("low")).select("doc_id", ids.alias("ids"))
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(f"(?<![^,])(?:{p})").alias("pattern")) for n, p in RULES))
    tagged = F.filter("ids", lambda x: x.startswith(SPDX_PREFIX))
    start = F.struct(
        F.concat(F.array_join(F.filter("ids", lambda x: ~x.startswith(SPDX_PREFIX)), ","), F.lit(",")).alias("rest"), F.expr("cast(array() as array<string>)").alias("names")
    )

    def apply(state: Column, rule: Column) -> Column:
        return F.struct(
            F.regexp_replace(state["rest"], rule["pattern"], F.lit("-,")).alias("rest"),
            F.when(F.regexp_like(state["rest"], rule["pattern"]), F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    read = F.when(F.size("ids") > 0, F.aggregate(rules, start, apply))
    rest = F.filter(F.split(F.col("read.rest"), ","), lambda x: ~x.isin("", "-", *NEUTRAL))
    names = F.concat("read.names", F.transform(tagged, lambda x: F.substr(x, F.lit(len(SPDX_PREFIX) + 1))))
    return rows.select("doc_id", "ids", read.alias("read")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct(names), ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size(rest) > 0, F.lit(False)).alias("unknown"),
    )
