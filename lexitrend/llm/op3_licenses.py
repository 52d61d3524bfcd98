"""Licence scans by sentence rules.

A text is cut into sentences (comment marks, line breaks and punctuation normalised away). Known
licence sentences have identifiers; a sentence is mapped to the identifiers of the patterns it
holds, in order of place, with a version where the sentence names one. A licence name that its
sentence denies (``do not use the ...``) has an identifier of its own, which no rule takes. Ordered
rules then match the sequence of identifiers from the front: the first rule that matches at a place
names the licence and uses up the identifiers it spans (others that are no licence names may stand
between, up to a small gap), so a full licence text is one finding and its single sentences are not
reported again. Texts without any licence word skip all this. Rows are scored where they are: no
shuffle, no state.

Results that are fixed here:

- one row per document; ``licenses`` lists findings in order of place, each licence once;
- a GNU licence is ``-or-later`` or ``-only`` where the text says so, else the bare version;
- ``all rights reserved`` means proprietary only in a text with no other finding; a name without a
  version is left out beside the same name with one;
- of rules that match at one place the first listed wins; of its matches, the shortest;
- ``n_unknown`` counts sentences that speak of licences but hold no known sentence;
- null and empty texts have no findings; repeated rows are scanned alike; whole texts are read;
- an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, out_batch, slices, texts_of

# --- fixed values: identifiers of known sentences (patterns over normalised sentences) ----------
_N = r"(\d+(?:\.\d+)*)"
_V = r"(?:[, -]{0,3}\(?(?:version|v)?\.? ?(\d+(?:\.\d+)*)\)?)?"
_OF = rf"(?:version {_N} of the )?(?:gnu )?"
SENTENCES: tuple[tuple[str, str], ...] = (
    ("SPDX", r"spdx license identifier:? ([a-z0-9.+-]+(?: (?:and|or|with) [a-z0-9.+-]+)*)"),
    ("ApacheRef", rf"apache(?: software)? licen[sc]e{_V}|\bapache[ -](?:version |v)?{_N}[ -]licen[sc]e"),
    ("LGPLRef", _OF + r"(?:lesser|library) general public licen[sc]e" + _V),
    ("AGPLRef", _OF + r"affero general public licen[sc]e" + _V),
    ("GPLRef", _OF + r"(?<!lesser )(?<!library )(?<!affero )general public licen[sc]e" + _V),
    ("GPLShort", rf"\b(l?a?gpl)[ -]?(?:version |v)?{_N}(\+|,? or[ -]later\b|[ -]only\b)?"),
    ("OrLater", rf"(?:version {_N} of the licen[sc]e,? )?or,? (?:\(?at your option\)? )?any later version|()\bor later\b"),
    ("Only", rf"version {_N} of the licen[sc]e,? only\b|\bonly version {_N}|(?<=\d )\(?only\b|(?<=licen[sc]e )only\b|\bno later version"
             r"|(?<=\d )as published by the free software foundation(?!.{0,40}later version)"),
    ("GPL2Preamble", r"licen[sc]es for most software are designed to take away your freedom"),
    ("GPL3Preamble", r"licen[sc]es for most software and other practical works are designed to take away"),
    ("LesserInstead", r"use the gnu (?:lesser|library) general public licen[sc]e instead of this licen[sc]e"),
    ("GFDLRef", rf"(?:gnu )?free documentation licen[sc]e{_V}|\bgfdl\b{_V}"),
    ("MPLRef", r"mozilla public licen[sc]e" + _V),
    ("EPLRef", r"eclipse public licen[sc]e" + _V),
    ("CDDLRef", r"common development and distribution licen[sc]e" + _V),
    ("ArtisticRef", r"artistic licen[sc]e" + _V),
    ("BoostRef", r"boost software licen[sc]e" + _V),
    ("CCRef", r"(?:cc|creative commons)[ -]((?:by|attribution)(?:[ -](?:nc|noncommercial|nd|noderivatives|noderivs|sa"
              r"|sharealike))*)(?:-(?=\d))?" + _V),
    ("CC0Ref", r"\bcc0\b|creative commons zero"),
    ("EUPLRef", rf"european union public licen[sc]e{_V}|\beupl{_V}\b"),
    ("OFLRef", rf"open font licen[sc]e{_V}|\bofl[ -]?v?{_N}"),
    ("AFLRef", rf"academic free licen[sc]e{_V}|\bafl[ -]?v?(\d+\.\d+)"),
    ("PSFRef", r"python software foundation licen[sc]e|\bpsf licen[sc]e"),
    ("MSPLRef", r"microsoft public licen[sc]e|\bms-pl\b"),
    ("X11Ref", r"\bx11 licen[sc]e"),
    ("BeerwareRef", r"\bbeer-?ware\b"),
    ("MITRef", r"\bmit(?:/x11)?(?: style)? licen[sc]e|licen[sc]ed? under (?:the )?mit\b|licen[sc]e: ?mit\b"),
    ("BSDRef", r"\b(?:(new|modified|simplified|revised|[0234][ -]clause) )?bsd(?: ([0234])[ -]clause)?(?: style)? licen[sc]e"),
    ("ISCRef", r"\bisc licen[sc]e"),
    ("ZlibRef", r"\bzlib(?:/libpng)? licen[sc]e"),
    ("UnlicenseText", r"free and unencumbered software released into the public domain"),
    ("WTFPLRef", r"do what the fuck you want to public licen[sc]e"),
    ("PublicDomain", r"(?:placed|released|dedicated)? ?(?:in|to|into) the public domain"),
    ("Proprietary", r"proprietary and confidential"),
    ("Reserved", r"all rights reserved"),
    ("ApacheGrant", r"perpetual,? worldwide,? non-exclusive,? no-charge,? royalty-free,? irrevocable copyright licen[sc]e"),
    ("ApachePatent", r"irrevocable \(except as stated in this section\) patent licen[sc]e"),
    ("ApacheNotice", r"software distributed under the licen[sc]e is distributed on an \"?'?as[ -]is\"?'? basis"),
    ("MITGrant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("MITNotice", r"above copyright notice and this permission notice shall be included"),
    ("ISCGrant", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose"),
    ("AsIs", r"(?:software|program|work)? ?is provided \"?'?as[ -]is"),
    ("NoLiability", r"in no event shall .{0,120}be liable"),
    ("BSDGrant", r"redistribution and use in source and binary forms"),
    ("BSDSource", r"redistributions of source code must retain"),
    ("BSDBinary", r"redistributions in binary form must reproduce"),
    ("BSDAdvert", r"all advertising materials mentioning features"),
    ("BSDEndorse", r"neither the names? of .{0,120}(?:endorse|promote)|may not be used to endorse or promote"),
    ("ZlibGrant", r"permission is granted to anyone to use this software for any purpose"),
    ("ZlibOrigin", r"origin of this software must not be misrepresented"),
    ("FreeSoftware", r"is free software[:;,]? you can redistribute it and/?o?r? ?modify"),
)
#: In a rule: any number of any identifiers.
ANY = "*"
#: Ordered: the first rule that matches at a place wins. ``{v}`` is the first version that a part names.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("{v}", ("SPDX",)),
    ("MIT", ("MITRef", "MITGrant", "MITNotice", "AsIs")),
    ("MIT", ("MITGrant", "MITNotice", "AsIs")),
    ("MIT", ("MITGrant", "AsIs")),
    ("ISC", ("ISCRef", "ISCGrant", "AsIs")),
    ("ISC", ("ISCGrant", "AsIs")),
    ("BSD-4-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDAdvert", "BSDEndorse")),
    ("BSD-3-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse")),
    ("BSD-2-Clause", ("BSDGrant", "BSDSource", "BSDBinary")),
    ("Zlib", ("ZlibGrant", "ZlibOrigin")),
    ("Unlicense", ("UnlicenseText",)),
    ("Apache-{v}", ("ApacheRef", "ApacheGrant", "ApachePatent")),
    ("Apache-{v}", ("ApacheRef", "ApacheNotice")),
    ("Apache-2.0", ("ApacheGrant", "ApachePatent")),
    ("GPL-3.0", ("GPLRef", "GPL3Preamble", ANY, "LesserInstead")),
    ("GPL-2.0", ("GPLRef", "GPL2Preamble", ANY, "LesserInstead")),
    ("GPL-3.0", ("GPLRef", "GPL3Preamble")),
    ("GPL-2.0", ("GPLRef", "GPL2Preamble")),
    ("GPL-3.0", ("GPL3Preamble",)),
    ("GPL-2.0", ("GPL2Preamble",)),
    ("AGPL-{v}-or-later", ("FreeSoftware", "AGPLRef", "OrLater")),
    ("LGPL-{v}-or-later", ("FreeSoftware", "LGPLRef", "OrLater")),
    ("GPL-{v}-or-later", ("FreeSoftware", "GPLRef", "OrLater")),
    ("AGPL-{v}-or-later", ("AGPLRef", "OrLater")),
    ("LGPL-{v}-or-later", ("LGPLRef", "OrLater")),
    ("GPL-{v}-or-later", ("GPLRef", "OrLater")),
    ("AGPL-{v}-only", ("AGPLRef", "Only")),
    ("LGPL-{v}-only", ("LGPLRef", "Only")),
    ("GPL-{v}-only", ("GPLRef", "Only")),
    ("AGPL-{v}", ("AGPLRef",)),
    ("LGPL-{v}", ("LGPLRef",)),
    ("GPL-{v}", ("GPLRef",)),
    ("{v}", ("GPLShort",)),
    ("Apache-{v}", ("ApacheRef",)),
    ("MPL-{v}", ("MPLRef",)),
    ("EPL-{v}", ("EPLRef",)),
    ("CDDL-{v}", ("CDDLRef",)),
    ("Artistic-{v}", ("ArtisticRef",)),
    ("BSL-{v}", ("BoostRef",)),
    ("GFDL-{v}", ("GFDLRef",)),
    ("EUPL-{v}", ("EUPLRef",)),
    ("OFL-{v}", ("OFLRef",)),
    ("AFL-{v}", ("AFLRef",)),
    ("PSF-2.0", ("PSFRef",)),
    ("MS-PL", ("MSPLRef",)),
    ("X11", ("X11Ref",)),
    ("Beerware", ("BeerwareRef",)),
    ("CC0-1.0", ("CC0Ref",)),
    ("{v}", ("CCRef",)),
    ("BSD{v}", ("BSDRef",)),
    ("ISC", ("ISCRef",)),
    ("Zlib", ("ZlibRef",)),
    ("MIT", ("MITRef",)),
    ("WTFPL", ("WTFPLRef",)),
    ("LicenseRef-public-domain", ("PublicDomain",)),
    ("LicenseRef-proprietary", ("Proprietary",)),
)
_RULES_OF: dict[str, list] = {}
for _rule in RULES:
    _RULES_OF.setdefault(_rule[1][0], []).append(_rule)
#: Other identifiers that may stand between two parts of a rule.
GAP = 3
#: Each match of a pattern above (and of ``_ABOUT``) holds one of these in the text as it stands. They
#: are single words, as line breaks and marks between two words are still there. ``Only`` counts in
#: sentences that hold such a word.
_WORDS = re.compile(r"licen|copyright|redistribut|permission|provided|liable|spdx|gpl|apache|later|cc0|creative"
                    r"|cc[^a-z0-9]+(?:by|attribution)|domain|unencumbered|reserved|confidential|endorse|promote"
                    r"|advertising|misrepresented|gfdl|eupl|ofl|afl|ms-pl|beer")
#: Names of licences: they end a rule's gap, and a sentence may deny them.
NAMES = frozenset(parts[0] for _, parts in RULES if len(parts) == 1)
_NOT = re.compile(r"(?:\b(?:not|never|cannot|neither|nor|no longer|none)\b|n't\b)([^,;:()]{0,80})$")
#: Words that turn a denial round (``not ... except``) or make it a condition (``if you did not ...``).
_YET = re.compile(r"\b(?:except|unless|but|only|other than|limited|if|without)\b")
_IF = re.compile(r"\b(?:if|unless|whether)\b[^,;:]*$")
_PATTERNS = tuple((name, re.compile(p)) for name, p in SENTENCES)
_MARKS = re.compile(r"(?m)^[\s]*(?:#+|//+|/\*+|\*+/?|--+|;+|%+|rem\b|dnl\b)?[ \t]*")
_END = re.compile(r"(?<=[.!?])(?<!\bv\.)\s+(?=\S)|\n\s*\n")
_KEEP = re.compile(r"[^a-z0-9.,:;()/'\"+-]+")
_ABOUT = re.compile(r"licen[sc]e|copyright|spdx|rights reserved")
_CC = (("attribution", "by"), ("noncommercial", "nc"), ("noderivatives", "nd"), ("noderivs", "nd"), ("sharealike", "sa"))


def normalise(sentence: str) -> str:
    return _KEEP.sub(" ", sentence).replace("spdx-license-identifier", "spdx license identifier").strip()


def version_of(name: str, m: re.Match) -> str:
    """The version (or the variant) a sentence names, as it stands in licence names."""
    if name == "SPDX":
        name = m[1].rstrip(".").upper()
        for word in ("or-later", "only", "Apache", " and ", " or ", " with ", "Clause", "Zlib"):
            name = name.replace(word.upper(), word)
        return name
    if name == "GPLShort":
        kind = "" if not m[3] else "-only" if m[3].endswith("only") else "-or-later"
        return f"{m[1].upper()}-{m[2] if '.' in m[2] else m[2] + '.0'}{kind}"
    if name == "CCRef":
        kind = m[1]
        for long, short in _CC:
            kind = kind.replace(long, short)
        return f"CC-{re.sub('[ -]+', '-', kind).upper()}-{(m[2] or '4.0').rstrip('.')}"
    if name == "BSDRef":
        n = m[2] or {"new": "3", "modified": "3", "revised": "3", "simplified": "2"}.get(m[1] or "", (m[1] or "")[:1])
        return f"-{n}-Clause" if n else ""
    v = next((g for g in m.groups() if g), "").rstrip(".")
    return v if not v or "." in v else f"{v}.0"


def denied(sentence: str, start: int) -> bool:
    """Whether the sentence denies the licence name that stands at ``start``."""
    before = _NOT.search(sentence, max(0, start - 100), start)
    return bool(before) and not _YET.search(before[1]) and not _IF.search(sentence, 0, before.start())


def identifiers(text: str) -> tuple[list[tuple[str, str]], int]:
    """The known sentences of a text in order, with versions, and the count of unknown ones."""
    found: list[tuple[str, str]] = []
    unknown = 0
    for sentence in _END.split(_MARKS.sub(" ", text.lower())):
        if not _WORDS.search(sentence):
            continue
        plain = normalise(sentence)
        here = sorted((m.start(), -m.end(), k, m) for k, (_, p) in enumerate(_PATTERNS) for m in p.finditer(plain))
        reach = -1
        for start, end, k, m in here:
            if start >= reach:      # the longest of patterns that overlap
                name = _PATTERNS[k][0]
                no = name in NAMES and denied(plain, start)
                found.append((f"Not{name}" if no else name, version_of(name, m)))
                reach = -end
        unknown += not here and bool(_ABOUT.search(plain))
    return found, unknown


def _end(found: list[tuple[str, str]], at: int, parts: tuple[str, ...], last: dict[str, int]) -> int:
    """The least place where a match of ``parts`` from ``at`` ends, or -1. All places a part can be
    at are followed up, so an early one that leads nowhere hides no later one."""
    places, far = [at], False
    for part in parts[1:]:
        if part == ANY:
            far = True
            continue
        if last.get(part, -1) <= places[0]:
            return -1
        nexts: set[int] = set()
        for p in places:
            for j in range(p + 1, len(found) if far else min(len(found), p + GAP + 2)):
                if found[j][0] == part:
                    nexts.add(j)
                    if far:
                        break
                if not far and found[j][0] in NAMES:
                    break
        if not nexts:
            return -1
        places, far = sorted(nexts), False
    return places[0]


def licences(found: list[tuple[str, str]]) -> list[str]:
    """The licences of a sequence of identifiers, by the ordered rules."""
    rest = [f for f in found if f[0] != "Reserved"]
    last = {name: k for k, (name, _) in enumerate(rest)}
    out: dict[str, None] = {}
    bare: list[str] = []
    at = 0
    while at < len(rest):
        step = 1
        for name, parts in _RULES_OF.get(rest[at][0], ()):
            end = _end(rest, at, parts, last)
            if end >= 0:
                version = next((v for part, v in rest[at: end + 1] if v and part in parts), "")
                full = name.replace("{v}", version).replace("--", "-").rstrip("-")
                if "{v}" in name and not version:
                    bare.append(full)
                out[full] = None
                step = end - at + 1
                break
        at += step
    for name in bare:
        if any(other.startswith(f"{name}-") for other in out):
            out.pop(name, None)
    if not out and len(rest) < len(found):
        out["LicenseRef-proprietary"] = None
    return list(out)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licenses, sentence_ids, n_unknown`` for each row; lists are comma-joined."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            schema = pa.schema([("doc_id", ids.type), ("licenses", pa.string()), ("sentence_ids", pa.string()),
                                ("n_unknown", pa.int64())])
            for lo, hi in slices(texts):
                names, sentences, unknown = [], [], []
                for t in texts_of(texts, lo, hi):
                    found, n = identifiers(t) if _WORDS.search(t.lower()) else ([], 0)
                    names.append(",".join(licences(found)))
                    sentences.append(",".join(f"{a}:{v}" if v else a for a, v in found))
                    unknown.append(n)
                yield out_batch(schema, {"doc_id": ids.slice(lo, hi - lo), "licenses": names,
                                         "sentence_ids": sentences, "n_unknown": unknown})

    return map_arrow(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, licenses string, sentence_ids string, "
                                "n_unknown long")
