"""License scans: ordered signature rules behind a keyword prefilter, native DataFrame expressions only.

A text is folded to lower-case words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with single
spaces. Each rule has a label, a priority, keywords and a regular expression
over folded words. Texts that contain none of the few ``STEMS`` are done; of the
others each rule runs only where one of its keywords stands. Both are read off
the expressions: each of a rule's alternatives has a keyword and a stem in what
it cannot leave out, so neither loses a detection. Detections are word
intervals; one that lies within another of the same or a higher priority is
suppressed (of equal intervals the higher priority stays, then the first label),
told by how far the earlier ones, in order of their starts, reach. The base phrases
always count, whatever the other rules find.

Everything happens within the row: no shuffle, no Python on the executors.

Defined results: null and empty texts have no words, labels or detections and
score 0; repeated rows give repeated rows; a very long text costs in proportion
to its length times the rules whose keywords it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Signatures of names, as "label; keyword; regular expression over folded words". An alternative that can do
#: without the keyword gets one of its own.
NAMES = """
apache-2.0; apache; apache (software )?licen[sc]e,?( version| v)?( 2( 0)?)
apache-1.1; apache; apache (software )?licen[sc]e( version| v)? 1 1
apache-1.0; apache; apache (software )?licen[sc]e( version| v)? 1 0
apache; apache; apache (software )?licen[sc]e
mit; mit; (the )?mit( x11| expat)? licen[sc]e
mit-0; mit no attribution; mit no attribution( licen[sc]e)?
x11; x11; x11 licen[sc]e
expat; expat; expat licen[sc]e
bsd-2-clause; licen; (simplified|freebsd|(bsd )?2 clause|two clause)( bsd)? licen[sc]e
bsd-3-clause; licen; (new|revised|modified|(bsd )?3 clause|three clause) (bsd )?licen[sc]e
bsd-4-clause; licen; (original|old|(bsd )?4 clause|four clause) (bsd )?licen[sc]e
bsd; bsd; bsd( style)? licen[sc]e
0bsd; bsd; (zero clause bsd|bsd zero clause|0bsd)( licen[sc]e)?
isc; isc; isc licen[sc]e
gpl-1.0; general public; gnu general public licen[sc]e( as published by the free software foundation)?( version| v) ?1( 0)?
gpl-2.0; general public; gnu general public licen[sc]e( as published by the free software foundation)?( version| v) ?2( 0)?
gpl-3.0; general public; gnu general public licen[sc]e( as published by the free software foundation)?( version| v) ?3( 0)?
gpl; general public; (gnu )?general public licen[sc]e
gpl-2.0; gpl; (gnu )?gpl( version| v)? ?2( 0)?
gpl-3.0; gpl; (gnu )?gpl( version| v)? ?3( 0)?
gpl; gnu gpl; gnu gpl
gpl-2.0; gplv2; (gnu )?gplv2
gpl-3.0; gplv3; (gnu )?gplv3
lgpl-2.0; library general; gnu library general public licen[sc]e( version| v)? ?2( 0)?
lgpl-2.1; lesser general; gnu lesser general public licen[sc]e( version| v)? ?2 1
lgpl-3.0; lesser general; gnu lesser general public licen[sc]e( version| v)? ?3( 0)?
lgpl; lesser general; (gnu )?lesser general public licen[sc]e
lgpl-2.1; lgpl; (gnu )?lgpl( version| v)? ?2 1
lgpl-3.0; lgpl; (gnu )?lgpl( version| v)? ?3( 0)?
agpl-3.0; affero; (gnu )?affero general public licen[sc]e( version| v)? ?3( 0)?
agpl; affero; (gnu )?affero general public licen[sc]e
agpl-3.0; agpl; (gnu )?agpl( version| v)? ?3( 0)?
fdl-1.3; free documentation; gnu free documentation licen[sc]e( version| v)? ?1 3
fdl-1.2; free documentation; gnu free documentation licen[sc]e( version| v)? ?1 2
fdl; free documentation; (gnu )?free documentation licen[sc]e
mpl-1.1; mozilla; mozilla public licen[sc]e( version| v)? ?1 1
mpl-2.0; mozilla; mozilla public licen[sc]e( version| v)? ?2( 0)?
mpl; mozilla; mozilla public licen[sc]e
epl-1.0; eclipse; eclipse public licen[sc]e( version| v)? ?1( 0)?
epl-2.0; eclipse; eclipse public licen[sc]e( version| v)? ?2( 0)?
epl; eclipse; eclipse public licen[sc]e
edl-1.0; eclipse; eclipse distribution licen[sc]e( version| v)? ?1( 0)?
cddl-1.0; common development; common development and distribution licen[sc]e( version| v)? ?1 0
cddl; common development; common development and distribution licen[sc]e
cpl-1.0; common public; common public licen[sc]e( version| v)?( 1( 0)?)?
ipl-1.0; ibm public; ibm public licen[sc]e
apsl-2.0; apple public; apple public source licen[sc]e
artistic-1.0; artistic; artistic licen[sc]e( version| v)? 1( 0)?
artistic-2.0; artistic; artistic licen[sc]e( version| v)? 2( 0)?
artistic; artistic; artistic licen[sc]e
bsl-1.0; boost; boost software licen[sc]e( version| v)?( 1( 0)?)?
busl-1.1; business source; business source licen[sc]e( version| v)?( 1 1)?
sspl-1.0; server side; server side public licen[sc]e
elastic-2.0; elastic; elastic licen[sc]e( version| v)?( 2( 0)?)?
commons-clause; commons clause; commons clause( licen[sc]e condition)?
unlicense; unlicense; (the )?unlicense
wtfpl; do what the; do what the [a-z]+ you want to public licen[sc]e
wtfpl; wtfpl; wtfpl( licen[sc]e)?
zlib; zlib; zlib( libpng)? licen[sc]e
libpng; libpng; libpng licen[sc]e
openssl; openssl; openssl licen[sc]e
php-3.01; php; php licen[sc]e( version| v)?( 3( 0?1)?)?
python-2.0; python; python software foundation licen[sc]e
python-2.0; psf; psf licen[sc]e
ruby; ruby; ruby licen[sc]e
perl; terms as perl; same terms as perl( itself)?
postgresql; postgresql; postgresql licen[sc]e
ncsa; ncsa; (university of illinois )?ncsa open source licen[sc]e
ofl-1.1; open font; (sil )?open font licen[sc]e( version| v)?( 1 1)?
odbl-1.0; open database; open database licen[sc]e
odc-by-1.0; data commons attribution; open data commons attribution licen[sc]e
pddl-1.0; public domain dedication; public domain dedication and licen[sc]e
ogl-3.0; open government; open government licen[sc]e( version| v)?( 3( 0)?)?
etalab-2.0; etalab; (licence ouverte )?etalab( open licen[sc]e)?
eupl-1.2; european union; european union public licen[sc]e( version| v)?( 1 [12])?
eupl-1.2; eupl; eupl( version| v)?( 1 [12])?
cecill; cecill; cecill( [bc])? (free software )?licen[sc]e( agreement)?
ms-pl; microsoft public; microsoft public licen[sc]e
ms-rl; microsoft reciprocal; microsoft reciprocal licen[sc]e
osl-3.0; open software; open software licen[sc]e( version| v)?( 3( 0)?)?
afl-3.0; academic free; academic free licen[sc]e( version| v)?( 3( 0)?)?
qpl-1.0; q public; q public licen[sc]e
sleepycat; sleepycat; sleepycat licen[sc]e
vim; vim licen; vim licen[sc]e
w3c; w3c; w3c software (notice and )?licen[sc]e
unicode; unicode; unicode (inc |data files and software )?licen[sc]e( agreement)?
openrail; openrail; (creativeml )?openrail( [mds]+)?( licen[sc]e)?
openrail; open rail; (creativeml )?open rail( [mds]+)?( licen[sc]e)?
llama; llama; llama( [0-9]+)? community licen[sc]e
blueoak-1.0.0; blue oak; blue oak model licen[sc]e
cc0-1.0; cc0; cc0( 1 0)?( universal)?( public domain dedication)?
cc-by; cc by; cc by( [1-4] [05])?
cc-by-sa; cc by sa; cc by sa( [1-4] [05])?
cc-by-nc; cc by nc; cc by nc( [1-4] [05])?
cc-by-nd; cc by nd; cc by nd( [1-4] [05])?
cc-by-nc-sa; cc by nc sa; cc by nc sa( [1-4] [05])?
cc-by-nc-nd; cc by nc nd; cc by nc nd( [1-4] [05])?
cc-by; creative commons; creative commons attribution( [1-4] [05])?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-sa; creative commons; creative commons attribution share ?alike( [1-4] [05])?( international| unported| generic)?( licen[sc]e)?
cc-by-nc; creative commons; creative commons attribution non ?commercial( [1-4] [05])?( international| unported)?( licen[sc]e)?
cc-by-nd; creative commons; creative commons attribution no ?deriv(ative)?s( works)?( [1-4] [05])?( licen[sc]e)?
cc-by-nc-sa; creative commons; creative commons attribution non ?commercial share ?alike( [1-4] [05])?( licen[sc]e)?
cc-by-nc-nd; creative commons; creative commons attribution non ?commercial no ?deriv(ative)?s( [1-4] [05])?( licen[sc]e)?
cc0-1.0; creative commons; creative commons( cc0| zero)( 1 0)?( universal)?
creative-commons; creative commons; creative commons( licen[sc]e)?
"""

#: Signatures of notices without a licence's name.
NOTICES = """
mit; permission is hereby; permission is hereby granted free of charge to any person obtaining a copy
isc; permission to use; permission to use copy modify and( or)? distribute this software for any purpose
bsd; redistribution and use; redistribution and use in source and binary forms
bsd-3-clause; endorse or promote; may be used to endorse or promote products derived from this software
zlib; provided as is; this software is provided as is without any express or implied warranty
unlicense; free and unencumbered; this is free and unencumbered software released into the public domain
public-domain; public domain; (released|placed|dedicated|is) (in|into|to) the public domain
public-domain; public domain; no copyright (is )?(claimed|reserved) public domain
public-domain; united states government; work of the united states government
gpl; redistribute it; you can redistribute it and or modify it under the terms of the gnu
gpl; free software foundation; published by the free software foundation
proprietary; proprietary; (confidential and proprietary|proprietary and confidential)
proprietary; permission; (reproduced?|copied|distributed) without( the)?( prior)?( written| express)? permission
proprietary; end user; end user licen[sc]e agreement
copyright; copyright; copyright( c)?( [0-9]{4})+( [0-9]{4})*
copyright; copyright; copyright (by|of|holders?|owners?)
copyright; copyrighted; (this|the) (work|material|text|content) is copyrighted
reserved; rights reserved; some rights reserved
reserved; reserved; all rights (are )?reserved
reserved; tous droits; tous droits r[eé]serv[eé]s
reserved; vorbehalten; alle rechte vorbehalten
reserved; derechos reservados; todos los derechos reservados
"""

#: What a grant says before a name.
GRANT = "(licen[sc]ed|released|distributed|available|published|made available|provided) under( the)?( terms of)?( the)?( conditions of the)? "
PRIORITY = {"spdx": 4, "grant": 3, "notice": 3, "name": 2, "link": 1}
WEIGHT = {4: 1.0, 3: 0.95, 2: 0.8, 1: 0.6, 0: 0.9}


def _rows(block: str) -> list[list[str]]:
    return [line.split("; ", 2) for line in block.strip().splitlines()]


def alternatives(pattern: str) -> list[list[str]]:
    """For each choice among an expression's alternatives, optional parts left out: the strings that any match of it
    contains, in order. Character classes, optional parts and repetitions end a string."""
    at = 0

    def branch() -> list[str]:  # one text per choice, "\0" where a string ends
        nonlocal at
        texts = [""]
        while at < len(pattern) and pattern[at] not in "|)":
            c = pattern[at]
            at += 1
            if c == "(":
                own = choices()
                at += 1
            elif c == "[":
                at, own = pattern.index("]", at) + 1, ["\0"]
            elif c.isalnum() or c in " ,":
                own = [c]
            else:
                raise ValueError(f"{c!r} in {pattern!r}")
            if pattern[at:at + 1] in ("?", "*"):
                at, own = at + 1, ["\0"]
            elif pattern[at:at + 1] == "+":
                at, own = at + 1, [f"{x}\0{x}" for x in own]
            elif pattern[at:at + 1] == "{":
                at, own = pattern.index("}", at) + 1, [f"{x}\0" for x in own]
            texts = [t + x for t in texts for x in own]
        return texts

    def choices() -> list[str]:
        nonlocal at
        texts = branch()
        while pattern[at:at + 1] == "|":
            at += 1
            texts += branch()
        return texts

    return [[s for s in t.split("\0") if s] for t in choices()]


def _keywords(keyword: str, pattern: str) -> str:
    """Keywords of which any match contains one, joined by "|": the given one, but for alternatives that can do without
    it their longest string."""
    own = [keyword if any(keyword in s for s in strings) else max(strings, key=len) for strings in alternatives(pattern)]
    return "|".join(dict.fromkeys(own))


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, keywords, regular expression), in order."""
    out = [(label, 0, phrase, phrase) for phrase, label in BASE]
    labels = dict.fromkeys(label for label, _, _ in _rows(NAMES))
    for label in labels:
        words = label.replace("-", " ").replace(".", " ")
        out.append((label, PRIORITY["spdx"], "spdx", f"spdx licen[sc]e identifier {words}( only| or later)?"))
    for label, keyword, pattern in _rows(NAMES):
        out.append((label, PRIORITY["grant"], keyword, GRANT + pattern))
    for label, keyword, pattern in _rows(NOTICES):
        out.append((label, PRIORITY["notice"], keyword, pattern))
    for label, keyword, pattern in _rows(NAMES):
        out.append((label, PRIORITY["name"], keyword, pattern))
    for label in labels:
        words = label.replace("-", " ").replace(".", " ")
        out.append((label, PRIORITY["link"], "opensource org", f"opensource org licen[sc]es? {words}"))
    return [(label, p, _keywords(keyword, pattern), pattern) for label, p, keyword, pattern in out]


def _stems() -> list[str]:
    """Strings of which any match of any rule contains one: "licen" where it must stand, else the alternative's keyword."""
    out = set()
    for _, _, keywords, pattern in rules():
        for strings in alternatives(pattern):
            if not any("licen" in s for s in strings):
                out.add(next(k for k in keywords.split("|") if any(k in s for s in strings)))
    out.add("licen")
    return sorted(s for s in out if not any(o in s for o in out - {s}))


STEMS = _stems()

#: Around a rule's matches; separators of words, so no folded text has them.
BEGIN, END = "\x01", "\x02"


def folded(text: Column) -> Column:
    """A text's words in lower case, each after a space, and a space at the end; one space without words.

    ``lower`` also folds letters beyond A-Z; none of those becomes a separator, and no base phrase can arise from one.
    """
    spaced = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(spaced, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _places(words: Column, rule: Column) -> Column:
    """Word intervals at which a rule's expression stands.

    One replacement puts marks, which no folded text has, around what it matches; the marked words' places are the
    intervals.
    """
    marked = F.split(F.regexp_replace(words, rule["regex"], F.lit(f" {BEGIN}$1{END}")), F.lit(" "), -1)

    def ends(tokens: Column, mark: Column) -> Column:  # the text begins with a space: word k is token k + 1
        return F.filter(F.transform(tokens, lambda t, i: F.when(mark(t), i)), lambda i: i.isNotNull())

    return _let(marked, lambda tokens: F.zip_with(
        ends(tokens, lambda t: t.startswith(BEGIN)), ends(tokens, lambda t: t.endswith(END)),
        lambda x, y: F.struct((x - 1).alias("start"), y.alias("stop"), rule["label"].alias("label"),
                              rule["priority"].alias("priority"))))


def detections(words: Column) -> Column:
    """All detections in a folded text, before any is suppressed."""
    by_keywords: dict[str, list[Column]] = {}
    for label, p, keywords, pattern in rules():
        by_keywords.setdefault(keywords, []).append(F.struct(
            F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(f" ((?:{pattern}))(?= )").alias("regex")))
    table = F.array(*[F.struct(F.array(*map(F.lit, k.split("|"))).alias("keywords"), F.array(*own).alias("rules"))
                      for k, own in by_keywords.items()])
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(words, F.lit(stem))
    none = F.array().cast("array<struct<start:int,stop:int,label:string,priority:int>>")
    run = F.flatten(F.transform(F.filter(
        table, lambda t: F.exists(t["keywords"], lambda k: F.contains(words, k))), lambda t: t["rules"]))
    found = F.transform(run, lambda r: F.when(F.regexp_like(words, r["regex"]), _places(words, r)).otherwise(none))
    return F.when(gate, F.flatten(found)).otherwise(none)


def resolved(found: Column) -> Column:
    """The detections that no other of the same or a higher priority contains.

    In order of their starts, one is contained where an earlier one of its priority or a higher one reaches its stop.
    How far the earlier ones reach is a running maximum for each priority, by doubling: after k steps each place knows
    the maximum of the 2^k places up to it, so n detections take log2(n) passes over arrays of n numbers.
    """
    order = F.array_sort(F.transform(
        F.filter(found, lambda d: d["priority"] > 0),
        lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("less_stop"), (-d["priority"]).alias("less_priority"),
                           d["label"].alias("label"))))
    levels = sorted(set(PRIORITY.values()))

    def reach(hits: Column) -> Column:  # at each place, by priority: the farthest stop up to there
        own = F.struct(*[F.transform(hits, lambda d: F.when(-d["less_priority"] >= F.lit(p), -d["less_stop"]).otherwise(F.lit(-1)))
                         .alias(f"reach{p}") for p in levels])
        steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(hits) + F.lit(1.0))).cast("int")),
                            lambda k: F.pow(F.lit(2), k).cast("int"))
        return F.aggregate(steps, own, lambda acc, width: F.struct(*[
            _doubled(acc[f"reach{p}"], width).alias(f"reach{p}") for p in levels]))

    def kept(hits: Column, reached: Column) -> Column:
        def free(d: Column, i: Column) -> Column:
            before = F.lit(-1)
            for p in levels:
                before = F.when(-d["less_priority"] == p, F.coalesce(F.get(reached[f"reach{p}"], i - 1), F.lit(-1))).otherwise(before)
            return before < -d["less_stop"]
        return F.transform(F.filter(hits, free), lambda d: F.struct(
            d["start"].alias("start"), (-d["less_stop"]).alias("stop"), d["label"].alias("label"), (-d["less_priority"]).alias("priority")))

    return _let(order, lambda hits: _let(reach(hits), lambda reached: kept(hits, reached)))


def _doubled(reached: Column, width: Column) -> Column:
    return F.transform(reached, lambda x, i: F.greatest(x, F.get(reached, i - width)))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (places of base phrases) and found (resolved detections) for every row of ``docs``."""
    words = docs.select("doc_id", folded(F.col("text")).alias("words"))
    hits = words.select("doc_id", (_spaces(F.col("words")) - 1).cast("bigint").alias("n_words"),
                        detections(F.col("words")).alias("hits"))
    return hits.select("doc_id", "n_words", F.filter("hits", lambda d: d["priority"] == 0).alias("base"),
                       F.when(F.size("hits") == 0, F.col("hits")).otherwise(resolved(F.col("hits"))).alias("found"))


def labelled(scanned: DataFrame) -> DataFrame:
    """The scan's digest: counts, first and last base place, labels and a score from 0 to 1."""
    names = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda d: d["label"])))
    weight = lambda d: F.lit(0.0) + sum((F.when(d["priority"] == p, w).otherwise(0.0) for p, w in WEIGHT.items()), F.lit(0.0))
    starts = F.transform("base", lambda d: d["start"].cast("bigint"))
    every = F.concat("base", "found")
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(names(F.col("base")), ",").alias("base_labels"), F.array_join(names(every), ",").alias("labels"),
        F.aggregate(every, F.lit(0.0), lambda a, d: F.greatest(a, weight(d))).alias("score"))
