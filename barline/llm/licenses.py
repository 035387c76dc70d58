"""License scan by ordered signature rules (DataFrame functions only).

Texts are lower-cased (A-Z) and cut into words; everything below works on the words
joined by single blanks.  A rule is a regular expression with a keyword.  A document
that holds no gate word is not scanned; of the others only the rules whose keyword
occurs are tried.  Detections become word intervals.  One that lies inside another of
higher priority (on a tie: the longer, then the earlier rule) is suppressed.

Base phrases are counted beside the rules, as places where their words stand
consecutively; their labels always stay.

Defined cases: null and empty texts have no words, no places, empty labels, null
positions and score 0; repeated rows give repeated results; a null id stays null;
extra columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import last_before, lower_ascii, sums_before, text_rows

# Fixed values of the base: phrase -> label.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document without any of these is not scanned by the rules; every match of a rule holds one.
GATE = ("licens", "licenc", "lizenz", "copyright", "copyleft", "spdx", "public domain", "creative commons", "cc by",
        "cc0", "warrant", "redistribut", "gpl", "all rights reserved", "hereby granted", "permission to use", "free software",
        "endorse or promote", "advertising materials", "what the fuck", "proprietary", "unauthorized",
        "bsd", " mpl ", " epl ", "eupl", " cddl", " ms pl ", " ms rl ", "wtfpl", "openrail", "open rail", "mit no attribution",
        "creativecommons org", "sil org ofl", "mariadb com bsl11", "edl v10", "vimhelp")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    regex: str
    score: float


# Families: label, name (regular expression over words), keyword, SPDX words, URL words.
FAMILIES = [
    ("gpl-1.0", "(gnu )?(general public license|gpl) (version |v ?)?1( 0)?", "1", "gpl 1 0( only| or later)?", "gnu org licenses( old licenses)? gpl 1 0"),
    ("gpl-2.0", "(gnu )?(general public license|gpl) (version |v ?)?2( 0)?", "2", "gpl 2 0( only| or later)?", "gnu org licenses( old licenses)? gpl 2 0"),
    ("gpl-3.0", "(gnu )?(general public license|gpl) (version |v ?)?3( 0)?", "3", "gpl 3 0( only| or later)?", "gnu org licenses gpl( 3 0)?"),
    ("lgpl-2.0", "(gnu )?(library general public license|lgpl) (version |v ?)?2( 0)?", "2", "lgpl 2 0( only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "(gnu )?(lesser general public license|lgpl) (version |v ?)?2 1", "2 1", "lgpl 2 1( only| or later)?", "gnu org licenses( old licenses)? lgpl 2 1"),
    ("lgpl-3.0", "(gnu )?(lesser general public license|lgpl) (version |v ?)?3( 0)?", "3", "lgpl 3 0( only| or later)?", "gnu org licenses lgpl( 3 0)?"),
    ("agpl-3.0", "(gnu )?(affero general public license|agpl)( version| v)?( ?3( 0)?)?", "a", "agpl 3 0( only| or later)?", "gnu org licenses agpl( 3 0)?"),
    ("gfdl-1.3", "(gnu )?free documentation license( version| v)?( ?1 3)?", "free documentation", "gfdl 1 3( only| or later)?", "gnu org licenses fdl( 1 3)?"),
    ("apache-1.1", "apache (software )?license (version |v ?)?1 1", "apache", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache (software )?license (version |v ?)?2( 0)?", "apache", "apache 2 0", "apache org licenses license 2 0"),
    ("mit", "(the )?(mit|expat) licen[sc]e", "licen", "mit", "opensource org licenses mit( license)?"),
    ("mit-0", "mit no attribution( licen[sc]e)?", "no attribution", "mit 0", "opensource org licenses mit 0"),
    ("bsd-2-clause", "(simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)( licen[sc]e)?", "bsd", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "(modified bsd|new bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)( licen[sc]e)?", "bsd", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "(original bsd|bsd 4 clause|4 clause bsd|four clause bsd)( licen[sc]e)?", "bsd", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", "(zero clause bsd|0bsd|bsd zero clause)( licen[sc]e)?", "bsd", "0bsd", "opensource org licenses 0bsd"),
    ("isc", "isc licen[sc]e", "isc", "isc", "opensource org licenses isc( license txt)?"),
    ("mpl-1.1", "(mozilla public license|mpl) (version |v ?)?1 1", "1 1", "mpl 1 1", "mozilla org mpl (mpl )?1 1"),
    ("mpl-2.0", "(mozilla public license|mpl) (version |v ?)?2( 0)?", "2", "mpl 2 0", "mozilla org( en us)? mpl 2 0"),
    ("epl-1.0", "(eclipse public license|epl) (version |v ?)?1( 0)?", "1", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "(eclipse public license|epl) (version |v ?)?2( 0)?", "2", "epl 2 0", "eclipse org legal epl( v20| 2 0)"),
    ("edl-1.0", "eclipse distribution license( version| v)?( ?1 0)?", "eclipse", "bsd 3 clause eclipse", "eclipse org org documents edl v10"),
    ("cddl-1.0", "(common development and distribution license|cddl)( version| v)?( ?1 0)?", "d", "cddl 1 0", "opensource org licenses cddl( 1 0|1)"),
    ("cpl-1.0", "common public license( version| v)?( ?1 0)?", "common public", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("artistic-1.0", "artistic license (version |v ?)?1( 0)?", "artistic", "artistic 1 0", "opensource org licenses artistic license 1 0"),
    ("artistic-2.0", "artistic license (version |v ?)?2( 0)?", "artistic", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("bsl-1.0", "boost software license( version| v)?( ?1 0)?", "boost", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", "business source license( version| v)?( ?1 1)?", "business source", "busl 1 1", "mariadb com bsl11"),
    ("sspl-1.0", "server side public license( version| v)?( ?1)?", "server side", "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2.0", "elastic license( version| v)?( ?2 0)?", "elastic", "elastic 2 0", "elastic co licensing elastic license"),
    ("zlib", "zlib( libpng)? licen[sc]e", "zlib", "zlib", "opensource org licenses zlib"),
    ("wtfpl", "(do what the fuck you want to public license|wtfpl)", "w", "wtfpl", "wtfpl net( about)?"),
    ("unlicense", "(the )?unlicense", "unlicense", "unlicense", "unlicense org"),
    ("cc0-1.0", "(cc0|creative commons zero)( 1 0)?( universal)?", "c", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creative commons attribution( licen[sc]e)?", "creative commons", "cc by", "creativecommons org licenses by"),
    ("cc-by-1.0", "(creative commons attribution|cc by) (version |v ?)?1 0", "1 0", "cc by 1 0", "creativecommons org licenses by 1 0"),
    ("cc-by-2.0", "(creative commons attribution|cc by) (version |v ?)?2 0", "2 0", "cc by 2 0", "creativecommons org licenses by 2 0"),
    ("cc-by-2.5", "(creative commons attribution|cc by) (version |v ?)?2 5", "2 5", "cc by 2 5", "creativecommons org licenses by 2 5"),
    ("cc-by-3.0", "(creative commons attribution|cc by) (version |v ?)?3 0", "3 0", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-4.0", "(creative commons attribution|cc by) (version |v ?)?4 0", "4 0", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-sa", "(creative commons attribution share ?alike|cc by sa)( \\d \\d)?", "s", "cc by sa \\d \\d", "creativecommons org licenses by sa"),
    ("cc-by-nc", "(creative commons attribution non ?commercial|cc by nc)( \\d \\d)?", " n", "cc by nc \\d \\d", "creativecommons org licenses by nc"),
    ("cc-by-nd", "(creative commons attribution no ?deriv(ative)?s?|cc by nd)( \\d \\d)?", " n", "cc by nd \\d \\d", "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", "(creative commons attribution non ?commercial share ?alike|cc by nc sa)( \\d \\d)?", " n", "cc by nc sa \\d \\d", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "(creative commons attribution non ?commercial no ?deriv(ative)?s?|cc by nc nd)( \\d \\d)?", " n", "cc by nc nd \\d \\d", "creativecommons org licenses by nc nd"),
    ("odbl", "open (data commons )?(open )?database license", "database", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by", "open data commons attribution license", "open data", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl", "public domain dedication and license", "public domain", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("ofl-1.1", "(sil )?open font license( version| v)?( ?1 1)?", "font", "ofl 1 1", "scripts sil org ofl"),
    ("openssl", "openssl license", "openssl", "openssl", "openssl org source license"),
    ("php-3.01", "php license( version| v)?( ?3 01)?", "php", "php 3 01", "php net license"),
    ("python-2.0", "(python software foundation|psf|python) license( version| v)?( ?2)?", "p", "(python|psf) 2 0", "python org psf license"),
    ("ruby", "ruby licen[sc]e", "ruby", "ruby", "ruby lang org en about license"),
    ("postgresql", "postgresql licen[sc]e", "postgresql", "postgresql", "postgresql org about licence"),
    ("ncsa", "(university of illinois )?ncsa( open source)? license", "ncsa", "ncsa", "opensource org licenses ncsa"),
    ("ms-pl", "microsoft public license|ms pl", "m", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft reciprocal license|ms rl", "m", "ms rl", "opensource org licenses ms rl"),
    ("eupl-1.2", "(european union public licen[sc]e|eupl)( version| v)?( ?1 [12])?", "eu", "eupl 1 [12]", "joinup ec europa eu (software page )?eupl"),
    ("cecill-2.1", "cecill( free software)? license( agreement)?( version| v)?( ?2 1)?", "cecill", "cecill 2 1", "cecill info licences"),
    ("upl-1.0", "universal permissive license( version| v)?( ?1 0)?", "universal permissive", "upl 1 0", "oss oracle com licenses upl"),
    ("osl-3.0", "open software license( version| v)?( ?3 0)?", "open software", "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3.0", "academic free license( version| v)?( ?3 0)?", "academic free", "afl 3 0", "opensource org licenses afl 3 0"),
    ("ecl-2.0", "educational community license( version| v)?( ?2 0)?", "educational", "ecl 2 0", "opensource org licenses ecl 2 0"),
    ("w3c", "w3c( software)?( notice and)? license", "w3c", "w3c", "w3 org consortium legal copyright software"),
    ("vim", "vim license", "vim", "vim", "vimhelp org uganda"),
    ("tcl", "tcl( tk)? license", "tcl", "tcl", "tcl tk software tcltk license"),
    ("x11", "x11 license", "x11", "x11", "spdx org licenses x11"),
    ("llama", "llama (2|3|3 1) community license( agreement)?", "llama", "llama( 2| 3)?", "(ai meta com|llama com) llama license"),
    ("openrail", "(bigscience |creativeml )?open ?rail( m)?( licen[sc]e)?", "rail", "(bigscience|creativeml) openrail m", "huggingface co spaces compvis stable diffusion license"),
]

#: Sentences of license texts and notices: label, priority, keyword, expression, score.
SENTENCES = [
    ("mit", 95, "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
    ("isc", 95, "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee", 1.0),
    ("bsd", 90, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("bsd-3-clause", 96, "endorse or promote", "neither the name of .{1,80} may be used to endorse or promote products derived from this software", 0.95),
    ("bsd-4-clause", 96, "advertising materials", "all advertising materials mentioning features or use of this software must display", 0.95),
    ("gpl", 92, "free software", "this (program|library|file|software) is free software you can redistribute it and or modify it under the terms of the gnu( general public license)?", 1.0),
    ("gpl-2.0", 97, "either version 2", "gnu general public license as published by the free software foundation either version 2", 1.0),
    ("gpl-3.0", 97, "either version 3", "gnu general public license as published by the free software foundation either version 3", 1.0),
    ("lgpl", 97, "lesser general public", "gnu lesser general public license", 0.9),
    ("agpl-3.0", 97, "affero", "gnu affero general public license", 0.9),
    ("gpl", 50, "gpl", "(gnu )?gpl", 0.6),
    ("gpl", 55, "general public", "(gnu )?general public licen[sc]e", 0.7),
    ("apache-2.0", 95, "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance", 1.0),
    ("apache", 55, "apache", "apache( software)? license", 0.8),
    ("mit", 55, "mit", "mit licensed", 0.7),
    ("mpl-2.0", 95, "mozilla public", "this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("mpl", 55, "mozilla public", "mozilla public license", 0.7),
    ("epl", 55, "eclipse public", "eclipse public license", 0.7),
    ("bsd", 50, "bsd", "bsd( style)? licen[sc]ed?", 0.7),
    ("bsl-1.0", 95, "boost", "distributed under the boost software license", 1.0),
    ("zlib", 95, "as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 0.95),
    ("unlicense", 95, "public domain", "this is free and unencumbered software released into the public domain", 1.0),
    ("cc0-1.0", 95, "public domain", "dedicated to the public domain by associating cc0", 0.95),
    ("public-domain", 70, "public domain", "(released|placed|dedicated) (in|into|to) the public domain", 0.8),
    ("public-domain", 40, "public domain", "public domain", 0.4),
    ("wtfpl", 95, "what the fuck", "do what the fuck you want to", 0.95),
    ("creative-commons", 45, "creative commons", "creative commons( licen[sc]e)?", 0.6),
    ("proprietary", 60, "all rights reserved", "all rights reserved", 0.3),
    ("proprietary", 80, "proprietary", "(confidential and proprietary|proprietary and confidential)", 0.7),
    ("proprietary", 80, "unauthorized", "unauthorized (copying|reproduction|distribution)( of this (file|software|material))?( is)?( strictly)? prohibited", 0.8),
    ("commercial", 70, "commercial licen", "commercial licen[sc]e", 0.6),
    ("warranty-disclaimer", 30, "warrant", "(provided|distributed) as is without warrant(y|ies)", 0.3),
    ("warranty-disclaimer", 30, "without any warranty", "without any warranty", 0.3),
]


def build_rules() -> list[Rule]:
    """Four forms for every family (SPDX tag, address, grant, title), then the sentences."""
    out = []
    for label, name, key, spdx, url in FAMILIES:
        out += [
            Rule(label, 100, "spdx", f"spdx license identifier {spdx}", 1.0),
            Rule(label, 90, label if url.startswith("(") else url.split(" ")[0], f"(https? )?(www )?{url}", 0.95),
            Rule(label, 80, "under", "(licensed|released|distributed|available|published|provided|offered|covered|shared) under "
                 f"(the )?(terms of )?(the )?({name})", 0.95),
            Rule(label, 60, key, f"({name})", 0.8),
        ]
    return out + [Rule(label, p, k, x, s) for label, p, k, x, s in SENTENCES]


RULES = build_rules()


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rules_column(rules: list[Rule]) -> Column:
    """The rules as one constant array, in order."""
    rows = ",".join(f"named_struct('ord',{k},'label',{_sql_text(r.label)},'priority',{r.priority},'keyword',"
                    f"{_sql_text(r.keyword)},'regex',{_sql_text(f'(?<= )(?:{r.regex})(?= )')},'score',{r.score}D)"
                    for k, r in enumerate(rules))
    return F.expr(f"array({rows})")


def n_words(blanked: str) -> str:
    """Words of a string in which every word has a blank on both sides of its own."""
    return f"IF({blanked} = '', 0L, length({blanked}) - length(replace({blanked}, '  ', ' ')) + 1L)"


def with_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, words`` with `` w1  w2 `` (two blanks between words; empty without words)."""
    flat = F.trim(F.regexp_replace(lower_ascii(F.coalesce("text", F.lit(""))), DELIMITERS, "  "))
    df = text_rows(docs, id_col, text_col).select("doc_id", flat.alias("_flat"))
    return df.select("doc_id", F.expr("IF(_flat = '', '', concat(' ', _flat, ' '))").alias("words"))


def base_places(base: dict[str, str]) -> Column:
    """``array<struct<label, first, last, n>>`` of the phrases that occur."""
    found = []
    for phrase, label in base.items():
        k = len(phrase.split())
        pattern = " " + phrase.replace(" ", "  ") + " "
        pieces = f"split(words, '{pattern}', -1)"
        found.append(f"transform(filter(array({pieces}), p -> size(p) > 1), p -> named_struct('label', '{label}', "
                     f"'first', {n_words('p[0]')}, 'last', n_words - {n_words('p[size(p) - 1]')} - {k}, "
                     f"'n', size(p) - 1L))")
    gate = " OR ".join(f"contains(words, ' {p.replace(' ', '  ')} ')" for p in base)
    return F.expr(f"CASE WHEN {gate} THEN concat({', '.join(found)}) "
                  "ELSE CAST(array() AS array<struct<label:string,first:bigint,last:bigint,n:bigint>>) END")


#: Every match of one rule ``r`` in ``line`` as character intervals: matches and the pieces between.
_MATCHES = f"""
transform(filter(array(named_struct('m', regexp_extract_all(line, r.regex, 0), 'p', split(line, r.regex, -1))),
                 x -> size(x.m) > 0),
  x -> flatten(transform(array(transform(x.m, (m, i) -> length(x.p[i]) + length(m))), t -> flatten(transform(array({sums_before('t')}), s ->
    transform(x.m, (m, i) -> named_struct(
      'ord', r.ord, 'label', r.label, 'priority', r.priority, 'score', r.score, 'start', s[i] + length(x.p[i]), 'len', length(m))))))))
"""

#: Detections that no detection of higher rank contains.  The matches of one rule are disjoint and in order, so only the
#: last of them that starts at or before a detection can contain it.
_INSIDE = f"""
filter(flatten(found), d -> NOT exists(found, g -> coalesce(exists(array({last_before('g', 'y.start <= d.start')}), e ->
  e.start + e.len >= d.start + d.len
  AND (e.priority > d.priority OR (e.priority = d.priority AND (e.len > d.len OR (e.len = d.len AND e.ord < d.ord))))), false)))
"""


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
                  rules: list[Rule] | None = None, gate: tuple[str, ...] = GATE) -> DataFrame:
    """One row per document with base counts, labels, score and the kept detections."""
    base = BASE if base is None else base
    rules = RULES if rules is None else rules
    df = with_words(docs, id_col, text_col).withColumn("n_words", F.expr(n_words("words")))
    open_ = " OR ".join(f"contains(line, {_sql_text(g)})" for g in gate)
    df = df.withColumn("base", base_places(base)).withColumn("line", F.expr("replace(words, '  ', ' ')"))
    df = df.withColumn("rules", F.when(F.expr(open_), rules_column(rules)))
    df = df.withColumn("found", F.expr(
        f"CASE WHEN rules IS NULL THEN NULL ELSE flatten(transform("
        f"filter(rules, r -> contains(line, r.keyword)), r -> {_MATCHES})) END"))
    df = df.withColumn("detections", F.expr(f"CASE WHEN found IS NULL THEN NULL ELSE {_INSIDE} END"))
    scores = "concat(transform(base, b -> 0.5D), coalesce(transform(detections, d -> d.score), array()))"
    return df.select(
        "doc_id", "n_words",
        F.expr("aggregate(base, 0L, (a, b) -> a + b.n)").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.first))").alias("first_word"),
        F.expr("array_max(transform(base, b -> b.last))").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(base, b -> b.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(transform(base, b -> b.label), "
               "coalesce(transform(detections, d -> d.label), array())))), ',')").alias("labels"),
        F.expr(f"coalesce(array_max({scores}), 0.0D)").alias("score"),
        F.expr("coalesce(transform(detections, d -> named_struct('label', d.label, 'priority', d.priority, 'start', "
               "d.start - 1, 'end', d.start - 1 + d.len)), array())").alias("detections"))
